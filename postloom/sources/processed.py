"""The ids that were processed, as intervals: a mark under which late low ids are not lost.

The table is append-only. A commit writes the intervals of the cells that it touched under
a new version; a cell's newest version counts. Intervals do not cross cells, so a join on
the cell finds all that can hold an id, at most half as many as a cell has ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from postloom.schemas import PROCESSED
from postloom.sources.tables import table_exists

# Ids of a cell: 2 ** CELL_BITS.
CELL_BITS = 10


def merged_intervals(intervals: DataFrame) -> DataFrame:
    """``(cell, lo, hi)`` without overlaps or neighbours, from such rows in any number and order."""
    by_cell = Window.partitionBy("cell").orderBy("lo", "hi")
    reached = F.max("hi").over(by_cell.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col("lo") <= reached + 1, 0).otherwise(1)
    numbered = intervals.select("cell", "lo", "hi").distinct().withColumn("_begins", begins).withColumn("_island", F.sum("_begins").over(by_cell))
    return numbered.groupBy("cell", "_island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select("cell", "lo", "hi")


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """``(cell, lo, hi)`` of the current mark; no rows if nothing was committed."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], PROCESSED).select("cell", "lo", "hi")
    versions = spark.read.schema(PROCESSED).parquet(path)
    newest = versions.groupBy("cell").agg(F.max("version").alias("version"))
    return versions.join(newest, ["cell", "version"]).select("cell", "lo", "hi")


def unprocessed(table: DataFrame, processed: DataFrame, columns=None, key: str = "id") -> DataFrame:
    """The rows whose id no interval holds, late ones with low ids too; null ids are left out."""
    rows = table.filter(F.col(key).isNotNull()).withColumn("_cell", F.shiftright(F.col(key).cast("long"), CELL_BITS))
    marks = processed.select(F.col("cell").alias("_of"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"))
    held = (F.col("_cell") == F.col("_of")) & F.col(key).between(F.col("_lo"), F.col("_hi"))
    return rows.join(marks, held, "left_anti").select(*(columns or table.columns))


def commit_processed(spark: SparkSession, path: str, ids: DataFrame, key: str = "id") -> None:
    """Add the ids of a run to the mark; call it only after the sink succeeded.

    A run that dies before repeats its rows. Committing ids again changes nothing.
    """
    point = F.col(key).cast("long")
    new = ids.filter(F.col(key).isNotNull()).select(F.shiftright(point, CELL_BITS).alias("cell"), point.alias("lo"), point.alias("hi"))
    version = 0
    if table_exists(spark, path):
        last = spark.read.schema(PROCESSED).parquet(path).agg(F.max("version")).first()[0]
        version = 0 if last is None else last + 1
    stored = read_processed(spark, path).join(new.select("cell").distinct(), "cell", "left_semi")
    merged = merged_intervals(stored.unionByName(new.distinct()))
    merged.select(F.lit(version).cast("long").alias("version"), "cell", "lo", "hi").write.mode("append").parquet(path)
