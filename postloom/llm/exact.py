"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from postloom.llm.common import Sieve, pick
from postloom.session import materialise

# Characters of a text that the second step hashes.
PREFIX_CHARS = 256


def exact_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", prefix_chars: int = PREFIX_CHARS, all_digests: bool = False) -> DataFrame:
    """``(key, keep, group_size, kept, text_sha256)``, one row per input row; of equal texts the largest key stays.

    The first pass takes the UTF-8 length and a hash of the first ``prefix_chars``
    characters, so whole texts are neither hashed nor moved, and counts their groups
    (merged in the tasks: a hot group is one row per task). A group of one row ends there.
    A sieve of the other groups tells the second pass which texts to hash whole; what
    passes wrongly is one digest more and a group of one. Texts are equal if their
    SHA-256 digests are. Only keys, lengths and digests are shuffled or written.

    Members of a digest are counted in salted parts, and each joins the total of its own
    part, so that copies that are a third of all rows spread over all tasks.

    ``text_sha256`` is null for rows that the refinement left alone, unless ``all_digests``
    asks for it. A null text is empty, so null and empty texts are equal. Of rows that
    repeat text and key one stays; null keys count as smaller than all others. Other
    columns are left out, whatever their names. An empty table gives none.
    """
    rows = pick(df, key=key, text=text).withColumn("text", F.coalesce("text", F.lit("")))
    placed = rows.withColumn("octets", F.octet_length("text")).withColumn("head", F.xxhash64("octets", F.substring("text", 1, prefix_chars)))
    shared = placed.groupBy("octets", "head").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # A shared group has two rows, so half of the rows bounds their number.
    sieve = Sieve.of(shared, F.col("head"), at_most=rows.count() // 2)
    whole = F.sha2(F.col("text").cast("binary"), 256)
    hashed = sieve.mark(placed, F.col("head"), "met").select(
        "key", "octets", "met", (whole if all_digests else F.when(F.col("met"), whole)).alias("digest"), F.monotonically_increasing_id().alias("row"))
    hashed = materialise(hashed, "text-digests")

    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = hashed.filter("met").withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)))
    parts = met.groupBy("octets", "digest", "salt").agg(F.max(F.struct("key", "row")).alias("top"), F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("octets", "digest")  # one row per salt
    totals = parts.select("octets", "digest", "salt", F.max("top").over(group).alias("top"), F.sum("n").over(group).alias("group_size"))
    grouped = met.join(totals, ["octets", "digest", "salt"]).select(
        "key", F.col("top.key").alias("keep"), "group_size", (F.col("row") == F.col("top.row")).alias("kept"), "digest")
    alone = hashed.filter("NOT met").select("key", F.col("key").alias("keep"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest")
    return grouped.unionAll(alone).select(F.col("key").alias(key), "keep", "group_size", "kept", F.col("digest").alias("text_sha256"))


def drop_exact_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows whose key stays, with all columns. Keys must be unique and not null."""
    stay = exact_duplicates(df, key, text).filter("kept").select(F.col(key).alias("_stay"))
    names = df.columns
    numbered = df.toDF(*[f"_{i}" for i in range(len(names))])
    return numbered.join(stay, F.col(f"_{names.index(key)}") == F.col("_stay"), "left_semi").toDF(*names)
