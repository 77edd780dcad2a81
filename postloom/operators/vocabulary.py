"""Exact model tokens by a vocabulary join: every different piece of text is encoded once.

A byte-level vocabulary never merges bytes across the pieces that its pattern cuts a text
into, so a text's tokens are those of its pieces. Pieces are cut by a column expression and
the different ones are encoded; counts and token borders come back by a join.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from postloom.session import materialise

# Fixed value: how the byte-level vocabularies split a text into pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The most frequent pieces, which go to all tasks; they are also those that would be hot keys.
FREQUENT_PIECES = 50_000


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """A vocabulary file of lines ``base64 rank``, from any file system that Spark reads."""
    lines = spark.read.text(path).filter("value <> ''").collect()  # as many as the vocabulary has tokens
    return {base64.b64decode(token): int(rank) for token, rank in (row["value"].split() for row in lines)}


def pieces(text: Column) -> Column:
    """The pieces of a text, in order; together they are the text."""
    return F.regexp_extract_all(text, F.lit(f"(?U){PATTERN}"), F.lit(0))


def whole_ends(data: bytes, tokens: list[bytes]) -> list[int]:
    """For each number of first tokens of ``data``, the octets that they fill with whole characters."""
    ends, filled = [0], 0
    for token in tokens:
        filled += len(token)
        whole = filled
        while whole < len(data) and data[whole] & 0xC0 == 0x80:  # inside a character of four octets at most
            whole -= 1
        ends.append(whole)
    return ends


@dataclass(frozen=True)
class Vocabulary:
    """``table (piece, n_pieces, n, ends)`` of all different pieces; ``frequent`` its most frequent rows.

    ``n`` is the number of tokens; ``ends[k]`` the octets that the first ``k`` tokens fill
    with whole characters (null for a piece of one token).
    """

    table: DataFrame
    frequent: DataFrame


def build_vocabulary(texts: DataFrame, ranks: dict[bytes, int], text: str = "text", frequent: int = FREQUENT_PIECES) -> Vocabulary:
    """Encode the different pieces of all texts, each once wherever and however often it occurs."""
    shared = texts.sparkSession.sparkContext.broadcast(ranks)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        encoding = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=shared.value, special_tokens={})
        for batch in batches:
            counts, ends = [], []
            for value in batch.column("piece"):
                piece = value.as_py()
                tokens = encoding.encode_ordinary(piece)
                counts.append(len(tokens))
                ends.append(whole_ends(piece.encode(), encoding.decode_tokens_bytes(tokens)) if len(tokens) > 1 else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("piece"), batch.column("n_pieces"), pa.array(counts, pa.int32()), pa.array(ends, pa.list_(pa.int32()))], ["piece", "n_pieces", "n", "ends"])

    different = texts.select(F.explode(pieces(F.col(text))).alias("piece")).groupBy("piece").agg(F.count(F.lit(1)).alias("n_pieces"))
    table = materialise(different.mapInArrow(encode, "piece string, n_pieces bigint, n int, ends array<int>"), "vocabulary")
    top = table.orderBy(F.desc("n_pieces"), "piece").limit(frequent)
    return Vocabulary(table, materialise(top.select("piece", "n", "ends"), "frequent-pieces"))


def model_token_counts(df: DataFrame, vocabulary: Vocabulary, key: str = "id", text: str = "text") -> DataFrame:
    """``(key, n_tokens)`` of every text that has a token. Keys are unique.

    Frequent pieces meet their counts where the text is read. What is left, a small share
    and none of it hot, is merged per text and joined by piece.
    """
    rows = df.select(F.col(key).alias("key"), F.explode(pieces(F.col(text))).alias("piece"))
    met = rows.join(F.broadcast(vocabulary.frequent.select("piece", "n")), "piece", "left")
    merged = met.groupBy("key", F.when(F.col("n").isNull(), F.col("piece")).alias("rest")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("times"))
    merged = materialise(merged, "piece-counts")
    rest = merged.filter("rest IS NOT NULL").join(vocabulary.table.select(F.col("piece").alias("rest"), F.col("n").alias("each")), "rest")
    counted = merged.filter("rest IS NULL").select("key", "n").unionAll(rest.select("key", F.col("each") * F.col("times")))
    return counted.groupBy("key").agg(F.sum("n").cast("int").alias("n_tokens")).withColumnRenamed("key", key)


def model_budget(df: DataFrame, vocabulary: Vocabulary, max_tokens: int, key: str = "id", text: str = "text") -> DataFrame:
    """``df`` with ``n_tokens`` and ``truncated``, texts over the budget cut after ``max_tokens`` tokens.

    A cut inside a character drops the rest of that character. Only texts over the budget
    are cut into pieces again, and of them the first ``max_tokens`` pieces only, since a
    piece has a token at least. A null text stays null and has no count, an empty one has 0.
    """
    # Written, as the texts over the budget and the result both read them.
    counts = materialise(model_token_counts(df, vocabulary, key, text), "token-counts")
    over = counts.filter(F.col("n_tokens") > max_tokens).select(key)
    first = df.select(key, text).join(over, key, "left_semi").select(F.col(key).alias("key"), F.posexplode(F.slice(pieces(F.col(text)), 1, max_tokens)).alias("pos", "piece"))
    found = first.join(F.broadcast(vocabulary.frequent), "piece", "left")
    # A piece that has met its tokens goes on as its length only.
    met = materialise(found.select("key", "pos", F.when(F.col("n").isNull(), F.col("piece")).alias("piece"), F.octet_length("piece").alias("size"), "n", "ends"), "first-pieces")
    rest = met.filter("n IS NULL").drop("n", "ends").join(vocabulary.table.drop("n_pieces"), "piece")
    placed = met.filter("n IS NOT NULL").unionByName(rest).drop("piece")
    before = F.sum("n").over(Window.partitionBy("key").orderBy("pos")) - F.col("n")  # max_tokens rows at most
    left = F.lit(max_tokens) - F.col("before")
    octets = F.when(left >= F.col("n"), F.col("size")).when(left > 0, F.get("ends", left.cast("int"))).otherwise(0)
    kept = placed.withColumn("before", before).groupBy("key").agg(F.sum(octets).cast("int").alias("_octets")).withColumnRenamed("key", key)
    joined = df.join(counts, key, "left").join(kept, key, "left")
    cut = F.when(F.col("_octets").isNull(), F.col(text)).otherwise(F.substring(F.col(text).cast("binary"), F.lit(1), F.col("_octets")).cast("string"))
    total = F.when(F.col(text).isNotNull(), F.coalesce("n_tokens", F.lit(0)))
    return joined.select(
        *[cut.alias(c) if c == text else F.col(c) for c in df.columns], total.alias("n_tokens"), (total > max_tokens).alias("truncated"))
