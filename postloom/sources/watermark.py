"""The committed high-water mark, kept as a small append-only control table.

Appending a version instead of replacing a file leaves the previous mark readable if
the job dies in the middle of a commit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from postloom.schemas import WATERMARK
from postloom.sources.tables import table_exists


def _latest(spark: SparkSession, path: str):
    if not table_exists(spark, path):
        return None
    versions = spark.read.schema(WATERMARK).parquet(path)
    return versions.agg(F.max("version").alias("version"), F.max_by("max_id", "version").alias("max_id")).first()


def read_watermark(spark: SparkSession, path: str, default: int = 0) -> int:
    latest = _latest(spark, path)
    return default if latest is None or latest["version"] is None else latest["max_id"]


def commit_watermark(spark: SparkSession, path: str, max_id: int) -> None:
    """Append the mark as the newest version; call it only after the sink succeeded."""
    latest = _latest(spark, path)
    version = 0 if latest is None or latest["version"] is None else latest["version"] + 1
    row = spark.range(0, 1, 1, 1).select(F.lit(version).cast("long").alias("version"), F.lit(max_id).cast("long").alias("max_id"))
    row.write.mode("append").parquet(path)


def watermark_table(spark: SparkSession, path: str) -> DataFrame:
    """The current mark as a one-row DataFrame."""
    return spark.read.schema(WATERMARK).parquet(path).agg(F.max_by("max_id", "version").alias("max_id"))
