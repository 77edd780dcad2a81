"""A document collection ``(id, document, embedding)`` stored as a parquet table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from postloom.operators.merge import insert_into
from postloom.sources.tables import ensure_table

COLLECTION_COLUMNS = ("id", "document", "embedding")


def _open(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def collection_add(rows: DataFrame, path: str, *, order_by, enrich: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Create the collection if needed and add the rows whose id it does not hold yet.

    Of several rows with one id the first by ``order_by`` is added.
    ``enrich`` makes the document and its embedding from the rows that are added.
    """
    def entries(added: DataFrame) -> DataFrame:
        return (enrich(added) if enrich else added).select(*COLLECTION_COLUMNS)

    ensure_table(rows.sparkSession, path, entries(rows).schema)
    insert_into(path, rows, key="id", order_by=order_by, enrich=entries)


def collection_peek(spark: SparkSession, path: str, n: int = 10) -> DataFrame:
    """The first ``n`` entries by id."""
    return _open(spark, path).orderBy("id").limit(n)


def collection_count(spark: SparkSession, path: str) -> DataFrame:
    return _open(spark, path).agg(F.count(F.lit(1)).alias("n"))


def collection_get(spark: SparkSession, path: str, include=("document",)) -> DataFrame:
    return _open(spark, path).select("id", *include)
