"""Row filters: recency, country, key lookup, text length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from postloom.functions.text import UNICODE_SPACE, word_count

MIN_WORDS = 50
RECENT_DAYS = 14

# Values per alternation; a longer list becomes several patterns joined by OR.
PATTERN_VALUES = 500


def recent_filter(df: DataFrame, as_of=None, days: int = RECENT_DAYS, ts: str = "timestamp") -> DataFrame:
    """Rows dated ``days`` days before ``as_of`` (default: today) or later; NULL dates drop."""
    today = F.current_date() if as_of is None else F.to_date(F.lit(as_of))
    return df.filter(F.to_date(F.col(ts)) >= F.date_sub(today, days))


def any_value_pattern(values, literal: bool = False) -> list[str]:
    """Regexes that together match a text containing any of the values."""
    parts = [f"\\Q{v.replace(chr(92) + 'E', chr(92) + 'E' + chr(92) * 2 + 'E' + chr(92) + 'Q')}\\E" if literal else f"(?:{v})" for v in values]
    return ["|".join(parts[i:i + PATTERN_VALUES]) for i in range(0, len(parts), PATTERN_VALUES)]


def country_filter(df: DataFrame, values: DataFrame, column: str = "location", literal: bool = False, lowercase: bool = True) -> DataFrame:
    """Rows whose location contains any of one country's values, ignoring case.

    Each value is a regex unless ``literal``, so short codes match inside longer words.
    The column comes back in lower case unless ``lowercase`` is off. ``values`` is the
    output of ``country_values``: entries of a single country out of one JSON document.
    They are folded into compiled patterns, which makes this a filter on the scan of any
    size of ``df`` instead of a join on a pattern condition.
    """
    entries = [row["value"] for row in values.select(F.lower("value").alias("value")).filter("value IS NOT NULL").distinct().collect()]
    lowered = F.lower(F.col(column))
    condition: Column = F.lit(False)
    for pattern in any_value_pattern(sorted(entries), literal):
        condition = condition | F.coalesce(lowered.rlike(pattern), F.lit(False))
    kept = df.filter(condition)
    return kept.withColumn(column, F.lower(F.col(column))) if lowercase else kept


def id_lookup(df: DataFrame, value, key: str = "id") -> DataFrame:
    return df.filter(F.col(key) == F.lit(value))


def id_lookup_in(df: DataFrame, keys: DataFrame, value, key: str = "id", other_key: str = "ids") -> DataFrame:
    """Rows of ``df`` with the given key, provided that the second table holds it too."""
    wanted = id_lookup(keys, value, other_key).select(F.col(other_key).alias(key))
    return id_lookup(df, value, key).join(wanted, key, "left_semi")


def needs_summary(col, min_words: int = MIN_WORDS) -> Column:
    """True for texts of more than ``min_words`` words; shorter ones pass through.

    Splitting ends after the words that decide, whatever the length of the text. White
    space at an end leaves an empty part there, and the last part is the rest of the text.
    """
    if min_words < 0:
        return word_count(col) > min_words
    parts = F.split(col, f"[{UNICODE_SPACE}]+", min_words + 2)
    return F.size(F.filter(parts, lambda part: part != "")) > min_words


def length_gate(df: DataFrame, text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Add ``words`` and ``gate`` (``summarise`` or ``pass``)."""
    counted = df.withColumn("words", word_count(F.col(text_col)))
    return counted.withColumn("gate", F.when(F.col("words") > min_words, "summarise").otherwise("pass"))
