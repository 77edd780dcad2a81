"""Scalar text expressions over posting columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Section layout, removed punctuation, embedding prefixes.
SECTION_LAYOUT = "#### {label}: {text} ####"
REMOVED_PUNCTUATION = "()',"
E5_PREFIXES = {"query": "query: ", "passage": "passage: "}

# What str.split() treats as whitespace; Java's \s alone covers ASCII only.
UNICODE_SPACE = r"\s\x1c-\x1f\x85\p{Z}"


def none_text(col) -> Column:
    """Text of a value, with NULL spelled ``None``."""
    return F.coalesce(F.col(col).cast("string") if isinstance(col, str) else col.cast("string"), F.lit("None"))


def section_format(label: str, col) -> Column:
    head, tail = SECTION_LAYOUT.replace("{label}", label).split("{text}")
    return F.concat(F.lit(head), none_text(col), F.lit(tail))


def clean_text(col) -> Column:
    return F.translate(col, REMOVED_PUNCTUATION, "")


def nest_sections(title="title", location="location", description="description") -> Column:
    """Array of the three cleaned sections of one posting."""
    return F.array(
        clean_text(section_format("title", title)),
        clean_text(section_format("location", location)),
        clean_text(section_format("description", description)),
    )


def join_sections(sections) -> Column:
    return F.array_join(sections, " ")


def posting_text(title="title", location="location", description="description") -> Column:
    return join_sections(nest_sections(title, location, description))


def e5_prefix(col, kind: str = "query") -> Column:
    """Prefix the encoder expects; stored postings use ``query`` by default."""
    return F.concat(F.lit(E5_PREFIXES[kind]), none_text(col))


def word_count(col) -> Column:
    return F.regexp_count(col, F.lit(f"[^{UNICODE_SPACE}]+"))


def regex_normalise(col) -> Column:
    """Lowercase runs of ASCII letters and colons, separated by single spaces.

    Replacing foreign characters and then collapsing whitespace equals one replacement
    of every run outside ``[A-Za-z:]``. The POSIX class is many times faster in Java
    than the same negated class written with two ranges.
    """
    return F.lower(F.trim(F.regexp_replace(col, r"[^\p{Alpha}:]+", " ")))
