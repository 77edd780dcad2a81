"""Parquet and CSV tables, and the append-only run report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from postloom.schemas import RUN_REPORT

# Texts hold quotes, line breaks and outer blanks; all of them must survive a round trip.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def parquet_scan(spark: SparkSession, path: str, columns=None) -> DataFrame:
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def with_file_order(scan: DataFrame, column: str = "file_order") -> DataFrame:
    """Add the place of each row of a file scan: its file, then its row there.

    A fixed order that no partitioning changes, for merges of sources without a column
    that orders their rows.
    """
    return scan.withColumn(column, F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index")))


def parquet_sink(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def csv_sink(df: DataFrame, path: str, columns=("id", "original", "summary"), mode: str = "overwrite") -> None:
    """Header and no index column; arrays become JSON text because CSV has no array type."""
    types = {field.name: field.dataType for field in df.schema.fields}
    encoded = [
        F.to_json(name).alias(name) if isinstance(types[name], (T.ArrayType, T.MapType, T.StructType)) else F.col(name)
        for name in columns
    ]
    df.select(*encoded).write.mode(mode).options(**CSV_OPTIONS).csv(path)


def csv_scan(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read what ``csv_sink`` wrote.

    The writer leaves NULL bare and quotes an empty text. Naming a NULL marker that no text
    contains makes the reader tell the two apart.
    """
    return spark.read.options(**CSV_OPTIONS, multiLine="true", nullValue="\u0000").schema(schema).csv(path)


def append_tables(first: DataFrame, second: DataFrame, source_column: str | None = None) -> DataFrame:
    """Rows of both tables, duplicates kept; ``source_column`` records the side (0 or 1)."""
    if source_column:
        first = first.withColumn(source_column, F.lit(0))
        second = second.withColumn(source_column, F.lit(1))
    return first.unionByName(second)


def rename_legacy_key(df: DataFrame) -> DataFrame:
    """Older embedding tables name the key ``ids``."""
    return df.withColumnRenamed("ids", "id")


def run_report_append(stats: DataFrame, path: str) -> None:
    """Append report rows; columns that ``stats`` lacks are stored as NULL."""
    present = set(stats.columns)
    columns = [
        (F.col(field.name) if field.name in present else F.lit(None)).cast(field.dataType).alias(field.name)
        for field in RUN_REPORT.fields
    ]
    stats.select(*columns).write.mode("append").parquet(path)


def run_report_scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_REPORT).parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Asks the file system; a failed read would show up as an error in the logs."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Create an empty parquet table at ``path`` unless one is there."""
    if not table_exists(spark, path):
        spark.createDataFrame([], schema).write.mode("append").parquet(path)
