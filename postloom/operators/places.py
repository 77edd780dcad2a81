"""The countries of locations, all of them in one pass."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

# Values that one automaton takes; the world's countries and subdivisions are some thousands.
MAX_VALUES = 200_000


def country_automaton(pairs: list[tuple[str, str]]) -> tuple[ahocorasick.Automaton | None, frozenset[str]]:
    """The automaton of ``(value, country)`` pairs, and the countries that have an empty value."""
    owners: dict[str, set[str]] = {}
    for value, country in pairs:
        owners.setdefault(value, set()).add(country)
    everywhere = frozenset(owners.pop("", ()))
    if not owners:
        return None, everywhere
    automaton = ahocorasick.Automaton()
    for value, countries in owners.items():
        automaton.add_word(value, tuple(sorted(countries)))
    automaton.make_automaton()
    return automaton, everywhere


def tag_countries(df: DataFrame, values: DataFrame, column: str = "location", output_col: str = "countries") -> DataFrame:
    """Add the sorted names of the countries any of whose values the location contains, ignoring case.

    For each country the rows that carry its name are those of ``country_filter`` with
    ``literal``, but the locations are read once for all countries and no row is joined: an
    automaton of all values finds them in one pass over a location, and each different
    location of a batch is searched once, so a location that very many rows share costs next
    to nothing. ``values`` is ``country_values`` of the whole dictionary, a document of its
    own that does not grow with ``df``; more than ``MAX_VALUES`` values are an error, not cut.

    A null location has no countries (an empty array); an empty one has those with an empty
    value. Null values and countries without name are left out. Other columns stay.
    """
    entries = values.select(F.lower("value").alias("value"), "country_name").filter("value IS NOT NULL AND country_name IS NOT NULL").distinct()
    pairs = sorted((row["value"], row["country_name"]) for row in entries.limit(MAX_VALUES + 1).collect())
    if len(pairs) > MAX_VALUES:
        raise ValueError(f"more than {MAX_VALUES} values of countries")

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def countries(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton, everywhere = country_automaton(pairs)

        def found(place: str) -> list[str]:
            names = set(everywhere)
            if automaton is not None:
                for _, owners in automaton.iter(place):
                    names.update(owners)
            return sorted(names)

        for places in batches:
            codes, different = pd.factorize(places)  # a null place has the code -1
            tags = [found(place) for place in different] + [[]]
            yield pd.Series([tags[code] for code in codes], index=places.index, dtype=object)

    return df.withColumn(output_col, countries(F.lower(F.col(column))))
