"""Splitting a generated summary into its labelled sections."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from postloom.operators.chat import CV_LABELS, JOB_LABELS, JOB_LABELS_SINGLE

# Both spellings of the job form; longer labels first, since one is a prefix of another.
JOB_SECTION_LABELS = tuple(dict.fromkeys(JOB_LABELS + JOB_LABELS_SINGLE))
CV_SECTION_LABELS = CV_LABELS


def label_pattern(labels) -> str:
    """Matches a label with its colon at the start of a line."""
    names = "|".join(re.escape(label) for label in sorted(labels, key=lambda l: (-len(l), l)))
    return rf"(?:^|\n)[ \t]*({names}):"


def split_summary_sections(df: DataFrame, labels=JOB_SECTION_LABELS, key: str = "id", text_col: str = "summary") -> DataFrame:
    """``(key, pos, section, value)`` for each label found, in text order.

    A value runs from its label to the next known label or the end; inline and multi-line
    values, blank lines and missing labels are all fine. Text before the first label is not
    part of any section. Labels and values come from the same pattern, so the i-th label
    belongs to the i-th piece after the first.
    """
    pattern = label_pattern(labels)
    split = df.select(
        key,
        F.regexp_extract_all(text_col, F.lit(pattern), F.lit(1)).alias("_labels"),
        F.split(text_col, pattern).alias("_pieces"),
    )
    paired = F.arrays_zip("_labels", F.slice("_pieces", F.lit(2), F.greatest(F.size("_labels"), F.lit(0))))
    # The outer form spares a derived filter that would match the pattern a second time.
    rows = split.select(key, F.posexplode_outer(paired).alias("pos", "_e")).filter("pos IS NOT NULL")
    return rows.select(key, "pos", F.col("_e._labels").alias("section"), F.regexp_replace(F.col("_e.1"), r"^\s+|\s+$", "").alias("value"))
