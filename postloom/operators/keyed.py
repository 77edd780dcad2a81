"""A stored table with the last row of each key, updated by buckets.

Files are grouped by a hash bucket of the key. An update writes the buckets that it changes
into a folder of its own, beside the ones that it reads, and then appends one small file to
the list of current folders. Readers open what that list names, so they see the table before
an update or after it, and a job that is lost leaves a folder that nothing names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from postloom.operators.merge import append_keep_last, last_per_key

# Rows of a bucket when the number of buckets follows from the table, and rows that one task writes.
BUCKET_ROWS = 1_000_000
# Buckets of a table: an update lists those that it touches on the driver, at most this many.
LEAST_BUCKETS, MOST_BUCKETS = 64, 4096
# Partition columns of the files; no column of a table may have these names.
VERSION, BUCKET = "_keyed_version", "_keyed_bucket"
CURRENT = "version long, folder string, bucket int, buckets int"


def _current_path(path: str) -> str:
    return f"{path}/_current"


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _current(spark: SparkSession, path: str) -> list[Row]:
    """``(version, folder, bucket, buckets)`` of the newest version of each bucket, at most MOST_BUCKETS rows.

    The one with bucket -1 stands for the table itself, which may have no rows.
    """
    listed = spark.read.schema(CURRENT).parquet(_current_path(path))
    newest = listed.groupBy("bucket").agg(F.max(F.struct("version", "folder", "buckets")).alias("c"))
    return newest.select("c.version", "c.folder", "bucket", "c.buckets").orderBy("bucket").collect()


def _read(spark: SparkSession, path: str, schema: T.StructType | None, folders: list[Row]) -> DataFrame:
    """The rows of some buckets; the table's columns only."""
    files = [f"{path}/{VERSION}={r['folder']}/{BUCKET}={r['bucket']}" for r in folders if r["bucket"] >= 0]
    if not files:
        if schema is None:
            raise ValueError(f"the table at {path} is empty: name its schema")
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", path)
    return (reader.schema(schema) if schema else reader).parquet(*files).drop(VERSION, BUCKET)


def _write(rows: DataFrame, path: str, key: str, version: int, buckets: int, at_most: int) -> None:
    """Write the buckets that ``rows`` has to a new folder, then list them as current.

    A bucket is written by as many tasks as its rows ask for, BUCKET_ROWS or so to each.
    """
    taken = {VERSION, BUCKET} & set(rows.columns)
    if taken:
        raise ValueError(f"column names {sorted(taken)} are the table's own")
    spark, folder = rows.sparkSession, f"{version:08d}-{uuid.uuid4().hex}"
    parts = max(1, -(-at_most // (buckets * BUCKET_ROWS)))
    part = F.pmod(F.shiftright(F.xxhash64(key), 32), F.lit(parts))  # other bits than the bucket's
    target = f"{path}/{VERSION}={folder}"
    rows.withColumn(BUCKET, _bucket(key, buckets)).repartition(F.col(BUCKET), part).write.partitionBy(BUCKET).parquet(target)
    written = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(target).select(BUCKET).distinct()
    written = written.unionAll(spark.range(1).select(F.lit(-1)))
    listed = written.select(
        F.lit(version).cast("long").alias("version"), F.lit(folder).alias("folder"), F.col(BUCKET).alias("bucket"), F.lit(buckets).alias("buckets"))
    listed.coalesce(1).write.mode("append").parquet(_current_path(path))  # one file: all buckets change at once


def create_keyed_table(rows: DataFrame, path: str, key: str = "id", *, order_by, buckets: int | None = None) -> None:
    """A table at the new ``path`` with the last row of each key.

    Without ``buckets`` there is one for each BUCKET_ROWS rows, within LEAST_BUCKETS and
    MOST_BUCKETS; larger buckets are written by several tasks. Null keys are one key.
    """
    n = rows.count()
    if buckets is None:
        buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, -(-n // BUCKET_ROWS)))
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"a table has 1 to {MOST_BUCKETS} buckets")
    _write(last_per_key(rows, key, order_by=order_by), path, key, 0, buckets, n)


def read_keyed_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The table as its last finished update left it; one without rows is read by its ``schema``."""
    return _read(spark, path, schema, _current(spark, path))


def update_table(path: str, new: DataFrame, key: str = "id", *, order_by) -> None:
    """Keep the last row per key in the keyed table at ``path``: a stored key's row is replaced.

    Only the buckets of new keys are read and written again, to a folder of their own; no
    file is replaced, so readers and a repeated task find what they opened. The stored side
    has one row per key, so an anti-join merges it. There must be a single writer. Updating
    again with the same rows changes nothing; an empty update does nothing.
    """
    spark = new.sparkSession
    current = _current(spark, path)
    buckets, version = current[0]["buckets"], max(r["version"] for r in current) + 1
    touched = {r["b"] for r in new.select(_bucket(key, buckets).alias("b")).distinct().collect()}  # at most MOST_BUCKETS
    if not touched:
        return
    folders = [r for r in current if r["bucket"] in touched]
    if folders:
        stored = _read(spark, path, new.schema, folders)
        # Null keys are equal to one another here, which a join does not see.
        stored = stored.filter(F.col(key).isNotNull()) if new.filter(F.col(key).isNull()).limit(1).count() else stored
        rows, at_most = append_keep_last(stored, new, key, order_by=order_by, existing_unique=True), stored.count() + new.count()
    else:
        rows, at_most = last_per_key(new, key, order_by=order_by), new.count()
    _write(rows, path, key, version, buckets, at_most)


def drop_old_versions(spark: SparkSession, path: str) -> int:
    """Delete the bucket folders that the table no longer names; their number.

    Those of lost updates too. Call it when no update runs and no reader has opened an older
    version.
    """
    live = {(f"{VERSION}={r['folder']}", f"{BUCKET}={r['bucket']}") for r in _current(spark, path)}
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    system, dropped = root.getFileSystem(spark._jsc.hadoopConfiguration()), 0
    for version in system.listStatus(root):
        name = version.getPath().getName()
        if not name.startswith(f"{VERSION}="):
            continue
        for bucket in system.listStatus(version.getPath()):
            if bucket.isDirectory() and bucket.getPath().getName().startswith(f"{BUCKET}=") and (name, bucket.getPath().getName()) not in live:
                dropped += system.delete(bucket.getPath(), True)
    return dropped
