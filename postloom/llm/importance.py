"""Importance resampling towards a target corpus by hashed n-grams, counted over joined batches of texts."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zlib
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from postloom.llm.common import pick
from postloom.operators.ordering import global_rank
from postloom.session import materialise

BUCKETS = 10_000
ORDER = 3
# Octets of text that are joined and searched at once.
BLOCK_OCTETS = 1 << 20
# Texts are in lower case where they are joined, so a capital is in none of them and in no word.
SENTINEL = b"A"
TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+|A")
GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
# Lengths whose shifts are tabled; longer words are shifted in several steps.
TABLED = 64
SPACE = np.uint32(zlib.crc32(b" "))


def _shift_tables() -> np.ndarray:
    """``[length, byte of the value, byte]``: what a CRC-32 becomes when so many octets follow, less their own CRC."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    out = np.empty((TABLED + 1, 4, 256), dtype=np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (np.uint32(8) * np.arange(4, dtype=np.uint32))[:, None]
    for length in range(1, TABLED + 1):
        out[length] = (out[length - 1] >> np.uint32(8)) ^ table[out[length - 1] & np.uint32(255)]
    return out.astype(np.uint32)


SHIFTS = _shift_tables()


def crc_after(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of texts followed by ``lengths`` octets, to be combined by XOR with the CRC-32 of those."""
    values, lengths = values.astype(np.uint32), lengths.astype(np.int64)
    while True:
        step = np.minimum(lengths, TABLED)
        values = (SHIFTS[step, 0, values & 255] ^ SHIFTS[step, 1, values >> 8 & 255] ^ SHIFTS[step, 2, values >> 16 & 255] ^ SHIFTS[step, 3, values >> 24])
        lengths = lengths - step
        if not lengths.any():
            return values


class KnownWords(dict):
    """CRC-32 and length of words in one number, remembered for a bounded number of them; the sentinel is 0."""

    def __init__(self, limit: int = 100_000):
        super().__init__({SENTINEL: 0})
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
            self[SENTINEL] = 0
        self[word] = value = len(word) << 32 | zlib.crc32(word)
        return value


def joined_blocks(texts: list[bytes], block: int = BLOCK_OCTETS) -> Iterator[bytes]:
    """The lower-cased texts in blocks of about ``block`` octets, a sentinel before each text.

    A long text is cut at gaps between words and goes on in the next block.
    """
    parts, size = [], 0
    for text in texts:
        parts.append(SENTINEL)
        start = 0
        lowered = text.lower()
        while start < len(lowered):
            cut = GAP.search(lowered, start + block - size) if len(lowered) - start > block - size else None
            end = cut.start() if cut else len(lowered)
            parts.append(lowered[start:end])
            size, start = size + end - start, end
            if size >= block:
                yield b"".join(parts)
                parts, size = [], 0
    if parts:
        yield b"".join(parts)


def hashed_ngrams(texts: list[bytes], known: KnownWords, buckets: int = BUCKETS, order: int = ORDER, block: int = BLOCK_OCTETS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per block ``(documents of its words, documents of its n-grams, their buckets)``; documents are numbered from 0.

    One pass of the pattern over the joined texts finds words and sentinels. The places of
    the sentinels are the documents' offsets, in which each word's document is searched;
    n-grams whose ends are in different documents are masked. The last words of a block
    stay in front of the next, so n-grams go on over blocks.
    """
    seen = 0
    values, docs = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    for joined in joined_blocks(texts, block):
        tokens = TOKEN.findall(joined)
        found = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
        offsets = np.flatnonzero(found == 0)
        at = np.flatnonzero(found)
        old = len(values)
        values = np.concatenate([values, found[at]])
        docs = np.concatenate([docs, seen - 1 + np.searchsorted(offsets, at, side="right")])
        seen += len(offsets)
        own, lengths = (values & np.uint64(0xFFFFFFFF)).astype(np.uint32), (values >> np.uint64(32)).astype(np.int64)
        spaced = crc_after(np.full(len(own), SPACE), lengths) ^ own
        owners, places = [docs[old:]], [own[old:] % np.uint32(buckets)]
        crc = own
        for n in range(2, order + 1):
            if len(values) < n:
                break
            crc = crc_after(crc[:len(values) - n + 1], lengths[n - 1:] + 1) ^ spaced[n - 1:]
            # Of the n-grams only those that end in this block are new.
            inside = docs[:len(values) - n + 1] == docs[n - 1:]
            inside[:max(0, old - n + 1)] = False
            owners.append(docs[:len(inside)][inside])
            places.append(crc[inside] % np.uint32(buckets))
        yield docs[old:], np.concatenate(owners), np.concatenate(places).astype(np.int64)
        keep = max(0, len(values) - order + 1)
        values, docs = values[keep:], docs[keep:]


def bucket_counts(df: DataFrame, text: str = "text", buckets: int = BUCKETS, order: int = ORDER) -> DataFrame:
    """``(bucket, n)``: occurrences of n-grams of 1 to ``order`` words by the CRC-32 of their octets.

    A task sends one row per bucket that it met, however much it reads.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, totals = KnownWords(), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, places in hashed_ngrams(batch.column("text").to_pylist(), known, buckets, order):
                totals += np.bincount(places, minlength=buckets)
        met = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(totals[met])], ["bucket", "n"])

    return _octets(pick(df, text=text)).mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def _octets(rows: DataFrame) -> DataFrame:
    return rows.withColumn("text", F.coalesce("text", F.lit("")).cast("binary"))


def bucket_gains(documents: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text", buckets: int = BUCKETS, order: int = ORDER) -> DataFrame:
    """``(bucket, gain)`` of every bucket: ``floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B))))``.

    ``s`` of ``S`` n-grams of all documents and ``t`` of ``T`` of all target texts are in
    the bucket, ``B`` is the number of buckets.
    """
    spark = documents.sparkSession
    own = materialise(bucket_counts(documents, text, buckets, order), "bucket-counts")
    aim = materialise(bucket_counts(target, target_text, buckets, order), "target-counts")
    size, aim_size = [float(counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) for counts in (own, aim)]
    both = spark.range(buckets).withColumnRenamed("id", "bucket").join(
        own.withColumnRenamed("n", "s"), "bucket", "left").join(aim.withColumnRenamed("n", "t"), "bucket", "left").fillna(0, ["s", "t"])
    t, s = F.col("t").cast("double") + 1, F.col("s").cast("double") + 1
    return both.select("bucket", F.floor(1000 * F.ln(t * F.lit(size + buckets) / (s * F.lit(aim_size + buckets)))).alias("gain"))


def weigh(documents: DataFrame, gains: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS, order: int = ORDER) -> DataFrame:
    """``(key, n_words, n_features, weight)`` per row: the gains of all its n-grams summed.

    The gains are one number per bucket, so they go to the tasks whole. Texts are read a
    second time instead of keeping their n-grams, which would be larger than the texts.
    """
    rows = _octets(pick(documents, key=key, text=text))
    table = np.zeros(buckets, dtype=np.int64)
    for row in gains.collect():  # one row per bucket
        table[row["bucket"]] = row["gain"]
    shared = documents.sparkSession.sparkContext.broadcast(table)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = KnownWords()
        for batch in batches:
            size = batch.num_rows
            words, features, weights = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
            for word_docs, docs, places in hashed_ngrams(batch.column("text").to_pylist(), known, buckets, order):
                words += np.bincount(word_docs, minlength=size)
                features += np.bincount(docs, minlength=size)
                weights += np.bincount(docs, weights=shared.value[places], minlength=size).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(words), pa.array(features), pa.array(weights)], ["key", "n_words", "n_features", "weight"])

    return rows.mapInArrow(weighed, f"key {rows.schema['key'].dataType.simpleString()}, n_words bigint, n_features bigint, weight bigint")


def gumbel(key: Column, seed: int) -> Column:
    """A row's draw, in thousandths, from the first 32 bits of ``sha256(seed:key)``; null for a null key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def resample(
    documents: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42, key: str = "doc_id", text: str = "text",
    target_text: str = "text", buckets: int = BUCKETS, order: int = ORDER,
) -> DataFrame:
    """``(key, n_words, n_features, weight, score, rank)`` of every row; ``rank`` is set for the rows that are drawn.

    The weight of a text is the log ratio, in thousandths, of target and documents under
    bags of hashed n-grams; with a Gumbel draw added, the highest scores are a sample
    without replacement in proportion to the ratios. Of the rows with ``least_words``
    words or more ``percent`` in a hundred are drawn (rounded down), ties to the smaller
    key. Ranks are counted in ranges of the order, so nothing is gathered.

    A null text is empty and has no n-grams. A row without key has no draw, so no score
    and no rank, and does not count. Rows that repeat a key are documents of their own.
    Other columns are left out. Empty tables give none; an empty target leaves gains to
    the documents' counts alone.
    """
    gains = bucket_gains(documents, target, text, target_text, buckets, order)
    weighed = materialise(weigh(documents, gains, key, text, buckets, order), "importance-weights")
    scored = weighed.withColumn("score", F.col("weight") + gumbel(F.col("key"), seed))
    scored = scored.withColumn("_last", (F.col("score").isNull() | (F.col("n_words") < least_words)).cast("int")).withColumn("_down", -F.col("score"))
    drawn = scored.filter("_last = 0").count() * percent // 100
    ranked = global_rank(scored, ["_last", "_down", "key"], "rank")
    return ranked.select(F.col("key").alias(key), "n_words", "n_features", "weight", "score", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long").alias("rank"))
