"""The country dictionary: continent -> countries -> subdivisions, as nested JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from postloom.schemas import COUNTRY_DICTIONARY


def read_country_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """One row per JSON file, column ``dictionary`` as text."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("dictionary"))


def country_values(dictionary: DataFrame, country: str | None = None, json_column: str = "dictionary") -> DataFrame:
    """``(country_name, kind, value)`` for one country: its name, code and capital, and the
    code and name of every subdivision. The name must match exactly; an unknown country
    gives no rows. Without a name the values of all countries.
    """
    continents = dictionary.select(F.explode(F.from_json(json_column, COUNTRY_DICTIONARY)).alias("continent", "details"))
    countries = continents.select(F.explode("details.Countries").alias("c"))
    if country is not None:
        countries = countries.filter(F.col("c.country_name") == F.lit(country))

    def entry(kind, value):
        return F.struct(F.lit(kind).alias("kind"), value.alias("value"))

    own = F.array(
        entry("name", F.col("c.country_name")),
        entry("code", F.col("c.country_code")),
        entry("capital", F.col("c.capital_english")),
    )
    parts = F.flatten(F.transform(
        F.coalesce(F.col("c.subdivisions"), F.array()),
        lambda s: F.array(
            entry("subdivision_code", s["subdivisions_code"]),
            entry("subdivision_name", s["subdivisions_name"]),
        ),
    ))
    return (
        countries.select(F.col("c.country_name").alias("country_name"), F.explode(F.concat(own, parts)).alias("entry"))
        .select("country_name", "entry.kind", "entry.value")
    )
