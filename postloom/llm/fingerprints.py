"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from postloom.llm.common import mixed, pick

# Cells of the sketch that is stored as the fingerprint, and digests' places in a sketch.
BASE_CELLS, HASHES = 16, 3
PARAGRAPH = re.compile(r"[^\n.!?]+[.!?]*")
PARAGRAPH_CHARS = 160
# Octets of text for one task when documents are put in order.
BLOCK_OCTETS = 32 << 20


def paragraph_digests(text: str) -> np.ndarray:
    """Sorted 64-bit digests of the paragraphs of a text.

    A paragraph is a line, cut after sentence ends and every PARAGRAPH_CHARS characters,
    so that a change in a long line does not hide the rest of it. Paragraphs that repeat
    get a digest for each repetition.
    """
    seen: dict[bytes, int] = {}
    digests = []
    for whole in PARAGRAPH.findall(text):
        whole = whole.strip()
        for start in range(0, len(whole), PARAGRAPH_CHARS):
            piece = whole[start:start + PARAGRAPH_CHARS].encode("utf-8", "surrogatepass")
            times = seen[piece] = seen.get(piece, -1) + 1
            digests.append(xxhash.xxh3_64_intdigest(piece, seed=times))
    return np.unique(np.array(digests, dtype=np.uint64))


@dataclass
class Sketch:
    """Cells of signed counts, digest sums and check sums (sums are exclusive ors)."""

    counts: np.ndarray
    digests: np.ndarray
    checks: np.ndarray

    @classmethod
    def of(cls, digests: np.ndarray, cells: int, signs: np.ndarray | None = None) -> "Sketch":
        """The sketch of digests, each counted once or by its sign."""
        if not len(digests):
            return cls(np.zeros(cells, np.int64), np.zeros(cells, np.uint64), np.zeros(cells, np.uint32))
        at, sums, checks = _places(digests, cells), np.zeros(cells, np.uint64), np.zeros(cells, np.uint32)
        counts = np.bincount(at, None if signs is None else _thrice(signs), cells).astype(np.int64)
        np.bitwise_xor.at(sums, at, _thrice(digests))
        np.bitwise_xor.at(checks, at, _thrice(_checks(digests)))
        return cls(counts, sums, checks)

    @classmethod
    def of_difference(cls, first: np.ndarray, second: np.ndarray, cells: int) -> "Sketch":
        """``of(first).minus(of(second))``, made at once."""
        return cls.of(np.concatenate((first, second)), cells, np.repeat([1, -1], [len(first), len(second)]))

    def minus(self, other: "Sketch") -> "Sketch":
        return Sketch(self.counts - other.counts, self.digests ^ other.digests, self.checks ^ other.checks)

    def text(self) -> str:
        parts = (self.counts.astype("<i4"), self.digests.astype("<u8"), self.checks.astype("<u4"))
        return base64.b64encode(b"".join(p.tobytes() for p in parts)).decode()

    @classmethod
    def parse(cls, text: str) -> "Sketch":
        data = base64.b64decode(text)
        cells = len(data) // 16
        return cls(np.frombuffer(data, "<i4", cells).astype(np.int64), np.frombuffer(data, "<u8", cells, 4 * cells), np.frombuffer(data, "<u4", cells, 12 * cells))

    def peel(self) -> tuple[np.ndarray, np.ndarray] | None:
        """Digests of the first side only and of the second only; None if cells stay entangled.

        All cells that hold one digest are emptied at once, round by round.
        """
        counts, sums, checks = self.counts.copy(), self.digests.copy(), self.checks.copy()
        found, signs = [], []
        for _ in range(len(counts) + 1):
            single = np.flatnonzero(np.abs(counts) == 1)
            single = single[_checks(sums[single]) == checks[single]]
            if not len(single):
                break
            digests, first = np.unique(sums[single], return_index=True)
            sign, at = counts[single][first], _places(digests, len(counts))
            found.append(digests)
            signs.append(sign)
            np.subtract.at(counts, at, _thrice(sign))
            np.bitwise_xor.at(sums, at, _thrice(digests))
            np.bitwise_xor.at(checks, at, _thrice(_checks(digests)))
        if counts.any() or sums.any() or checks.any():
            return None
        digests, sign = np.concatenate(found or [sums[:0]]), np.concatenate(signs or [counts[:0]])
        return digests[sign > 0], digests[sign < 0]


_SHIFTS = np.array([[0], [21], [42]], dtype=np.uint64)


def _thrice(values: np.ndarray) -> np.ndarray:
    """The values once for each part of the table."""
    return np.concatenate((values,) * HASHES)


def _places(digests: np.ndarray, cells: int) -> np.ndarray:
    """One cell for each digest in each of HASHES parts of the table, part after part."""
    h, part = mixed(digests ^ np.uint64(cells)), cells // HASHES
    shares = h >> _SHIFTS & np.uint64(0x1FFFFF)
    widths = np.array([[part], [part], [cells - 2 * part]], dtype=np.uint64)
    return ((shares * widths >> np.uint64(21)).view(np.int64) + np.array([[0], [part], [2 * part]])).ravel()


def _checks(digests: np.ndarray) -> np.ndarray:
    return ((digests * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


@dataclass
class Fingerprint:
    """The paragraph digests of a document and the sketch of them that is stored."""

    digests: np.ndarray
    base: Sketch

    @classmethod
    def of(cls, text: str) -> "Fingerprint":
        digests = paragraph_digests(text)
        return cls(digests, Sketch.of(digests, BASE_CELLS))


def difference(first: Fingerprint, second: Fingerprint) -> tuple[np.ndarray, np.ndarray, int]:
    """Digests that only one of two documents has, and the cells that were needed.

    Tries the stored sketches first. If their difference cannot be peeled, sketches of four
    times as many cells are tried, and so on: cells follow the size of the difference and
    not that of the documents. The places of digests change with the size, so digests that
    met everywhere part.
    """
    cells, sides = BASE_CELLS, first.base.minus(second.base).peel()
    while sides is None:
        cells *= 4
        sides = Sketch.of_difference(first.digests, second.digests, cells).peel()
    return *sides, cells


def likeness(first: Fingerprint, second: Fingerprint) -> float:
    """Jaccard similarity of the paragraphs, from the peeled difference; 1 for two empty texts."""
    only_first, only_second, _ = difference(first, second)
    union = len(first.digests) + len(only_second)
    return 1.0 if union == 0 else (len(first.digests) - len(only_first)) / union


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [Fingerprint.of(value.as_py() or "").base.text() for value in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found, pa.string())], ["key", "fingerprint"])


def fingerprint(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, fingerprint)``: the base sketch of every whole text; a null text is empty."""
    rows = pick(df, key=key, text=text)
    return rows.mapInArrow(_fingerprints, f"key {rows.schema['key'].dataType.simpleString()}, fingerprint string").withColumnRenamed("key", key)


def block_bounds(rows: DataFrame, block_octets: int) -> np.ndarray:
    """Keys at which blocks of about ``block_octets`` of text, twice that at most, begin.

    They are quantiles of the keys, each taken once and once more for every average length
    that its text has: at most twice as many values as rows, by which long texts that lie
    together are spread. The driver holds one number per block.
    """
    sized = rows.filter("key IS NOT NULL").select("key", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("octets"))
    total, n = sized.agg(F.coalesce(F.sum("octets"), F.lit(0)), F.count(F.lit(1))).first()
    blocks = max(4 * rows.sparkSession.sparkContext.defaultParallelism, -(-total // block_octets))
    average = max(1, total // max(1, n))
    weighted = sized.select("key", F.explode(F.sequence(F.lit(0), F.floor(F.col("octets") / average))))
    return np.unique(np.array(weighted.approxQuantile("key", [i / blocks for i in range(1, blocks)], 1 / (4 * blocks)), dtype=np.float64))


def with_successor(df: DataFrame, key: str, text: str, block_octets: int = BLOCK_OCTETS) -> tuple[DataFrame, int]:
    """Rows of ``(key, text, block, tail)`` in blocks of rising keys, and the number of blocks.

    Every block ends with a copy of the first row of the next block (``tail``), the last
    one with that of the first: in a block, each document is followed by its successor.
    Bounds are keys between which lie about ``block_octets`` of text; the driver holds one
    bound and one first key per block. Null keys come last, in a block of their own. Only
    this one shuffle moves texts.
    """
    rows = pick(df, key=key, text=text)
    bounds = block_bounds(rows, block_octets)
    last = np.iinfo(np.int64).max

    def numbers(keys: pd.Series, no_key: pd.Series) -> np.ndarray:
        return np.where(no_key, len(bounds) + 1, np.searchsorted(bounds, keys.astype("float64"), side="right"))

    @F.pandas_udf(T.LongType())
    def block_of(keys: pd.Series, no_key: pd.Series) -> pd.Series:
        return pd.Series(numbers(keys, no_key))

    # A null key stands behind all others; without nulls the functions see whole numbers.
    keyed = rows.withColumn("no_key", F.col("key").isNull()).withColumn("known", F.coalesce(F.col("key").cast("long"), F.lit(last)))
    firsts = keyed.select("known", "no_key").groupBy(block_of("known", "no_key").alias("block")).agg(F.min("known").alias("first")).orderBy("block").collect()
    previous = {row["block"]: firsts[i - 1]["block"] for i, row in enumerate(firsts)}
    first = {row["block"]: row["first"] for row in firsts}

    @F.pandas_udf("own bigint, before bigint")
    def place(keys: pd.Series, no_key: pd.Series) -> pd.DataFrame:
        own = numbers(keys, no_key)
        before = [previous[b] if first[b] == k else None for b, k in zip(own.tolist(), keys.tolist())]
        return pd.DataFrame({"own": own, "before": pd.array(before, dtype="Int64")})

    placed = keyed.withColumn("_at", place("known", "no_key"))
    copies = F.array_compact(F.array(
        F.struct(F.col("_at.own").alias("block"), F.lit(False).alias("tail")),
        F.when(F.col("_at.before").isNotNull(), F.struct(F.col("_at.before").alias("block"), F.lit(True).alias("tail")))))
    return placed.select("key", "text", F.explode(copies).alias("_c")).select("key", "text", "_c.block", "_c.tail"), len(bounds) + 2


def edited(text: str, successor: str) -> str:
    """The last half of a text replaced by the start of its successor."""
    half = len(text) // 2
    return text[:len(text) - half] + successor[:half]


RESULT = "key bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _versions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document against its edited text and its successor; two documents are held at a time."""
    block = key = text = own = None
    done = True  # the block's tail was seen
    names = [part.split()[0] for part in RESULT.split(", ")]

    for batch in batches:
        out: list[tuple] = []
        for next_key, next_text, next_block, tail in zip(*(batch.column(c) for c in ("key", "text", "block", "tail"))):
            next_key, next_text, next_block, tail = next_key.as_py(), next_text.as_py() or "", next_block.as_py(), tail.as_py()
            if next_block == block and done:
                continue  # further rows with the key of the next block's first
            following = Fingerprint.of(next_text)
            if next_block == block:
                changed = edited(text, next_text)
                other = Fingerprint.of(changed)
                out.append((
                    key, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                    own.base.text(), other.base.text(), likeness(own, other), likeness(own, following)))
            block, key, text, own, done = next_block, next_key, next_text, following, tail
        kinds = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}
        columns = list(zip(*out)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, kinds[part.split()[1]]) for c, part in zip(columns, RESULT.split(", "))], names)


def compare_versions(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``.

    Compares every document with its edited text (see ``edited``) and with its successor
    by rising key; the last is followed by the first, a single one by itself. Keys are
    integers. Rows that repeat a key follow each other by text; of those at the start of a
    block the first is the successor of the block before. Null keys come last, null texts
    are empty. Equal texts have equal fingerprints.
    """
    rows, blocks = with_successor(df, key, text)
    ordered = rows.repartitionById(blocks, F.col("block").cast("int")).sortWithinPartitions("block", "tail", F.col("key").asc_nulls_last(), "text")
    return ordered.mapInArrow(_versions, RESULT).withColumnRenamed("key", key)
