"""Keyed merges of new rows into an existing table.

``insert_ignore`` keeps the existing row of a key, ``append_keep_last`` the newest one.
Which of several new rows counts as first or last is decided by columns that the caller
names (``file_order`` of a scan gives the order of files and rows); a table has no order of
its own. The winner of a key is ``row_number() = 1``: Spark drops the losers of each task
before the shuffle, so a key with very many copies does not gather in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F


def _one_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    window = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def _names(order_by) -> list[str]:
    names = [order_by] if isinstance(order_by, str) else list(order_by)
    if not names:
        raise ValueError("name the columns that order the rows of a key")
    return names


def _keys(df: DataFrame, key: str) -> DataFrame:
    """Each key once: copies are merged in the tasks, so none is heavy in a join."""
    return df.select(key).distinct()


def first_per_key(df: DataFrame, key: str = "id", *, order_by) -> DataFrame:
    return _one_per_key(df, key, [F.col(n).asc() for n in _names(order_by)])


def last_per_key(df: DataFrame, key: str = "id", *, order_by) -> DataFrame:
    return _one_per_key(df, key, [F.col(n).desc() for n in _names(order_by)])


def fresh_rows(existing: DataFrame, new: DataFrame, key: str = "id", *, order_by) -> DataFrame:
    """The rows of ``new`` that an insert would add: first of each key, key not stored yet.

    The existing side is first cut to the keys that ``new`` contains. With a small
    increment Spark broadcasts that key list after checking its size, and the large table
    is scanned for one column but never shuffled; otherwise it falls back to a shuffled
    join on the unique key.
    """
    candidates = first_per_key(new, key, order_by=order_by)
    clashes = existing.select(key).join(_keys(new, key), key, "left_semi")
    return candidates.join(clashes, key, "left_anti").select(*new.columns)


def insert_ignore(existing: DataFrame, new: DataFrame, key: str = "id", *, order_by) -> DataFrame:
    """The table after inserting ``new``; rows of keys already present are ignored."""
    added = fresh_rows(existing, new, key, order_by=order_by)
    return existing.unionByName(added.select(*existing.columns))


def insert_into(path: str, new: DataFrame, key: str = "id", *, order_by, enrich: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Append the fresh rows to the parquet table at ``path`` and return their number.

    ``enrich`` turns the surviving rows into rows of the table. Expensive columns belong
    there: they are computed once, and only for rows that are inserted.

    One plan without intermediate tables: the increment is shuffled by key once, to find
    the first row of each key, and the same partitioning serves the anti-join with the
    stored keys. The key range of ``new`` limits the scan of the stored keys: keys mostly
    grow, so an increment skips nearly all older files. Parquet has no unique index, so
    there must be a single writer; running the same insert again adds nothing.
    """
    low, high = new.agg(F.min(key), F.max(key)).first()
    if low is None:
        return 0
    stored = new.sparkSession.read.parquet(path).select(key).filter(F.col(key).between(low, high))
    fresh = first_per_key(new, key, order_by=order_by).join(stored, key, "left_anti").select(*new.columns)
    added = Observation()
    written = (enrich(fresh) if enrich else fresh).observe(added, F.count(F.lit(1)).alias("n"))
    written.write.mode("append").parquet(path)
    return added.get["n"]


def insert_report(existing: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """``(initial_count, jobs_added, final_count)`` of the insert, in one job."""
    added = _keys(new, key).join(existing.select(key), key, "left_anti")
    sides = existing.select(F.lit(1).alias("old"), F.lit(0).alias("add")).unionByName(
        added.select(F.lit(0).alias("old"), F.lit(1).alias("add"))
    )
    initial = F.coalesce(F.sum("old"), F.lit(0))
    jobs_added = F.coalesce(F.sum("add"), F.lit(0))
    return sides.agg(initial.alias("initial_count"), jobs_added.alias("jobs_added"), (initial + jobs_added).alias("final_count"))


def append_keep_last(existing: DataFrame, new: DataFrame, key: str = "id", *, order_by, existing_unique: bool = False) -> DataFrame:
    """The existing rows followed by the new ones, keeping the last row of each key.

    When the stored table is known to hold one row per key (it was written by this
    operator), ``existing_unique`` avoids ranking it again: stored rows of replaced keys
    are dropped by an anti-join and the rest passes through unshuffled if ``new`` is small.
    """
    if existing_unique:
        kept = existing.join(_keys(new, key), key, "left_anti").select(*existing.columns)
        return kept.unionByName(last_per_key(new, key, order_by=order_by).select(*existing.columns))
    stacked = existing.withColumn("_src", F.lit(0)).unionByName(new.withColumn("_src", F.lit(1)))
    order = [F.col("_src").desc()] + [F.col(n).desc() for n in _names(order_by)]
    return _one_per_key(stacked, key, order).select(*existing.columns)
