"""Helpers shared by the operators: input columns by exact name, and fixed-size membership bitmaps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from postloom.operators.sieve import SIEVE_BITS, Sieve  # noqa: F401  (the operators take it from here)

# 2 ** 24 bits: 2 MiB wherever a bitmap goes, however large the set that it stands for.
BITMAP_BITS = 24


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The columns ``new_name=name`` of ``df`` only, found by exact name.

    Other columns go, whatever they are called: names that repeat, or differ in case
    only, or hold dots would otherwise make a reference ambiguous. Of columns with one
    name the first is taken.
    """
    for name in columns.values():
        if name not in df.columns:
            raise ValueError(f"no column {name!r} in {df.columns}")
    numbered = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return numbered.select(*[F.col(f"_{df.columns.index(name)}").alias(new) for new, name in columns.items()])


def hashed_sample(df: DataFrame, group: str, key: str, limit: int, counts: dict) -> DataFrame:
    """About ``limit`` rows of each group, never more: those whose keys have the smallest hashes.

    ``counts`` has the rows of each group. Rows beyond twice the expected hash leave where
    they are read, so a group that is most of the table does not gather in one task.
    """
    draw = F.shiftrightunsigned(F.xxhash64(key), 11) / float(1 << 53)
    bound = F.element_at(F.create_map(*[F.lit(x) for g, n in counts.items() for x in (g, min(1.0, 2.0 * limit / n))]), F.col(group)) if counts else F.lit(1.0)
    near = df.withColumn("_draw", draw).filter(F.col("_draw") <= bound)
    rank = F.row_number().over(Window.partitionBy(group).orderBy("_draw", key))
    return near.withColumn("_rank", rank).filter(F.col("_rank") <= limit).drop("_rank", "_draw")


def bitmap_of(keys: Column, df: DataFrame) -> np.ndarray:
    """A bitmap of the top bits of 64-bit hash keys, built by an aggregate.

    The driver gets at most ``2 ** (BITMAP_BITS - 6)`` rows of 16 bytes (4 MiB), for any
    number of keys. A set bit is a hint: an exact join must follow.
    """
    top = F.shiftrightunsigned(keys, 64 - BITMAP_BITS)
    words = (
        df.select(F.shiftright(top, 6).cast("int").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (top % 64).cast("int")).alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    )
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.uint64)
    bitmap[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return bitmap


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the uint64 ``hashes`` may be members."""
    top = hashes >> np.uint64(64 - BITMAP_BITS)
    return (bitmap[(top >> np.uint64(6)).astype(np.int64)] >> (top & np.uint64(63))) & np.uint64(1) == 1


def mixed(hashes: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64: every input bit reaches every output bit."""
    h = hashes ^ (hashes >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; after the last one Arrow's unused memory goes back, as worker processes outlive their tasks."""
    yield from batches
    pa.default_memory_pool().release_unused()


class HashedWords(dict):
    """64-bit hashes of words, remembered for a bounded number of different words."""

    def __init__(self, limit: int = 100_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value
