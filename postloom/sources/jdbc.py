"""Database tables: parallel incremental reads and insert-ignore by append."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from postloom.operators.merge import fresh_rows
from postloom.schemas import POSTING_COLUMNS
from postloom.sources.postings import incremental_scan

INSERT_BATCH = 1000


def jdbc_options(url: str, table: str, max_id: int, upper_id: int, partitions: int, fetch_size: int = 10_000, key: str = "id", **extra) -> dict[str, str]:
    """Reader options for a parallel read of the keys above ``max_id``.

    The key range is cut into ``partitions`` slices, so each task opens one connection and
    streams its slice.
    """
    if partitions < 1:
        raise ValueError("partitions must be positive")
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(max_id + 1),
        "upperBound": str(max(upper_id, max_id + 1)),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
        "pushDownPredicate": "true",
        **{k: str(v) for k, v in extra.items()},
    }


def jdbc_write_options(url: str, table: str, batch_size: int = INSERT_BATCH, **extra) -> dict[str, str]:
    """Writer options; text goes to the server untyped, so it can parse a vector from it."""
    return {"url": url, "dbtable": table, "batchsize": str(batch_size), "stringtype": "unspecified", **{k: str(v) for k, v in extra.items()}}


def vector_text(col) -> Column:
    """An array as ``[1.0,2.0]``, the text form of a vector column."""
    return F.concat(F.lit("["), F.array_join(F.transform(col, lambda v: v.cast("string")), ","), F.lit("]"))


def jdbc_increment(spark: SparkSession, url: str, table: str, max_id: int, partitions: int, columns=POSTING_COLUMNS, key: str = "id", **extra) -> DataFrame:
    """Rows above the mark: the current upper end first, then a parallel read up to it."""
    reader = spark.read.format("jdbc").options(url=url, **{k: str(v) for k, v in extra.items()})
    newest = reader.option("query", f"SELECT MAX({key}) AS max_id FROM {table}").load().first()
    upper_id = max_id if newest is None or newest[0] is None else int(newest[0])
    source = spark.read.format("jdbc").options(**jdbc_options(url, table, max_id, upper_id, partitions, key=key, **extra)).load()
    return incremental_scan(source, max_id, upper_id, columns, key)


def rows_to_insert(stored: DataFrame, new: DataFrame, key: str = "id", vector_col: str = "embedding", *, order_by) -> DataFrame:
    """The rows of ``new`` that the table lacks, vectors as text; of one key the first by ``order_by``."""
    return fresh_rows(stored, new, key, order_by=order_by).withColumn(vector_col, vector_text(vector_col))


def jdbc_insert(new: DataFrame, url: str, table: str, partitions: int, key: str = "id", vector_col: str = "embedding", batch_size: int = INSERT_BATCH, *, order_by, **extra) -> None:
    """Append the rows whose key the database table lacks, in batches per task.

    Only the stored keys inside the key range of ``new`` are read. Spark writes each task in
    a transaction of its own, so a failed run may leave some rows; repeating it skips them.
    """
    low, high = new.agg(F.min(key), F.max(key)).first()
    if low is None:
        return
    options = jdbc_options(url, table, low - 1, high, partitions, key=key, **extra)
    stored = new.sparkSession.read.format("jdbc").options(**options).load().select(key).filter(F.col(key).between(low, high))
    rows = rows_to_insert(stored, new, key, vector_col, order_by=order_by)
    rows.write.format("jdbc").options(**jdbc_write_options(url, table, batch_size, **extra)).mode("append").save()
