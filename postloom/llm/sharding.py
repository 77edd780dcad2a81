"""Sharding by rendezvous hashing of stable record keys over weighted shards."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from postloom.llm.common import pick

# Rows that one task ranks when slots are numbered.
ROWS_PER_BLOCK = 20_000


def rendezvous_scores(key: Column, weights: Sequence[float]) -> Column:
    """``array<struct<score, shard>>``: an exponential race of all shards for a key.

    Shard ``s`` draws a 32-bit number from ``md5(key:s // 4)``, four shards to a digest,
    so its draw depends on nothing but the key and its own number. The score is
    ``-ln(u) / weight``; the smallest wins, which gives a shard its share of the weights.
    A shard that is added can only win keys for itself, one that is removed only loses its
    own. A null key counts as one key.
    """
    if not weights or any(not w > 0 or math.isinf(w) for w in weights):
        raise ValueError("weights must be positive")
    n = len(weights)
    digests = F.transform(
        F.sequence(F.lit(0), F.lit((n - 1) // 4)),
        lambda block: F.md5(F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("<null>")), block.cast("string"))),
    )
    weight_of = F.lit([float(w) for w in weights])

    def score(digests: Column, shard: Column) -> Column:
        digest = F.get(digests, F.floor(shard / 4).cast("int"))
        draw = F.conv(F.substr(digest, (shard % 4) * 8 + 1, F.lit(8)), 16, 10).cast("double")
        return F.struct((-F.ln((draw + 0.5) / float(1 << 32)) / F.get(weight_of, shard)).alias("score"), shard.alias("shard"))

    # The digests are one element of an outer array, so that each is made once per key.
    return F.get(F.transform(F.array(digests), lambda d: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda s: score(d, s))), 0)


def winner(scores: Column) -> Column:
    """The shard with the smallest score; of equal scores the smaller shard number."""
    return F.array_min(scores)["shard"]


def number_slots(df: DataFrame, shard: str, order: Sequence[str], key: str, n_shards: int, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Add ``slot``: gapless from 0 in every shard.

    Shards are cut into blocks by a hash of the key, as many as the row count asks for, so
    a task ranks one block however large a shard is. Blocks are counted first (one column
    is read); their running totals are the blocks' first slots. Slots follow block, then
    ``order``; rows that are equal in all of these share a run of slots in any order.
    """
    blocks = max(1, math.ceil(df.count() / (n_shards * rows_per_block)))
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("<null>")), F.lit("block")))
    df = df.withColumn("_block", F.conv(F.substr(digest, F.lit(1), F.lit(8)), 16, 10).cast("long") % blocks)
    earlier = Window.partitionBy(shard).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    first = df.groupBy(shard, "_block").agg(F.count(F.lit(1)).alias("_n")).select(
        shard, "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"))
    within = Window.partitionBy(shard, "_block").orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(within) - 1)
    return ranked.join(first, [shard, "_block"]).withColumn("slot", F.col("_first") + F.col("_rank")).drop("_block", "_first", "_rank")


def shard_records(
    df: DataFrame, weights: Sequence[float], key: str = "doc_id", text: str = "text", grown_weight: float | None = None, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """``(key, size, text_crc32, shard, slot, grown_shard)``, one row per input row.

    The shard depends on the key and the weights only. ``grown_weight`` is the weight of
    one more shard; ``grown_shard`` tells where a row would be with it (null without).
    ``size`` is the UTF-8 length of the text plus 8; a null text has no bytes and the
    checksum of the empty text. Rows that repeat a key share its shard. Null keys are one
    key. Other columns, whatever their names, are left out. An empty table gives none.
    """
    scores = rendezvous_scores(F.col("key"), [*weights, *([grown_weight] if grown_weight else [])])
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = pick(df, key=key, text=text).withColumn("_scores", scores).select(
        "key",
        (F.octet_length(body) + 8).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        winner(F.slice("_scores", 1, len(weights))).alias("shard"),
        (winner(F.col("_scores")) if grown_weight else F.lit(None).cast("int")).alias("grown_shard"),
    )
    slotted = number_slots(rows, "shard", ["key", "size", "text_crc32"], "key", len(weights), rows_per_block)
    return slotted.select(F.col("key").alias(key), "size", "text_crc32", "shard", "slot", "grown_shard")
