"""Incremental reads of the postings table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from postloom.schemas import POSTING_COLUMNS


def incremental_scan(table: DataFrame, max_id: int = 0, upper_id: int | None = None, columns=POSTING_COLUMNS, key: str = "id") -> DataFrame:
    """Rows whose key lies strictly above the high-water mark ``max_id``.

    The filter is a plain comparison with a literal, so parquet and JDBC receive it.
    ``upper_id`` pins the upper end: a run that first reads the new mark and then the
    rows sees one consistent slice even while the source keeps growing.
    """
    rows = table.filter(F.col(key) > F.lit(max_id))
    if upper_id is not None:
        rows = rows.filter(F.col(key) <= F.lit(upper_id))
    return rows.select(*columns)


def watermark_advance(new_rows: DataFrame, max_id: int, key: str = "id") -> DataFrame:
    """One row ``max_id``: the largest new key, or the old mark when nothing is new."""
    return new_rows.agg(F.coalesce(F.max(key), F.lit(max_id)).cast("long").alias("max_id"))
