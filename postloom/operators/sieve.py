"""Membership bitmaps of any set of keys in a bounded number of rows."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from postloom.session import materialise

# A sieve has 16 to 32 bits for each of its keys, up to 2 ** 26: 8 MiB in 2 ** 20 rows.
SIEVE_BITS = 26


@dataclass(frozen=True)
class Sieve:
    """A membership bitmap in column functions only: rows ``(sieve_word, sieve_bits)`` of 64 bits each.

    It is sized by the number of keys and never has more than ``2 ** (SIEVE_BITS - 6)``
    rows, so it may be broadcast. Beyond some 10 ** 7 keys it fills up and lets more rows
    through, which costs work and no correctness: what passes must be checked exactly.
    """

    bits: int
    words: DataFrame

    @classmethod
    def of(cls, df: DataFrame, hashes: Column, at_most: int | None = None) -> "Sieve":
        """A sieve of all keys; ``at_most`` bounds their number, else they are counted."""
        bits = min(SIEVE_BITS, max(10, math.ceil(math.log2(16 * (df.count() if at_most is None else at_most) + 1))))
        top = F.shiftrightunsigned(hashes, 64 - bits)
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (top % 64).cast("int"))
        words = df.select(F.shiftright(top, 6).alias("sieve_word"), bit.alias("bit")).groupBy("sieve_word").agg(F.bit_or("bit").alias("sieve_bits"))
        # The rows are so few by construction that one file holds them.
        return cls(bits, materialise(words.repartition(1), "sieve"))

    def mark(self, rows: DataFrame, hashes: Column, name: str) -> DataFrame:
        """``rows`` with a boolean column: false for keys that are not members."""
        placed = rows.withColumn("_top", F.shiftrightunsigned(hashes, 64 - self.bits))
        joined = placed.join(F.broadcast(self.words), F.shiftright("_top", 6) == F.col("sieve_word"), "left")
        hit = F.coalesce(F.getbit("sieve_bits", (F.col("_top") % 64).cast("int")) == 1, F.lit(False))
        return joined.withColumn(name, hit).drop("_top", "sieve_word", "sieve_bits")
