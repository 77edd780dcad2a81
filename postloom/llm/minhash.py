"""Near-duplicates: one-permutation hashing, banded buckets, star-shaped candidate edges.

Every whole text is a set of word shingles. Equal sets are grouped by a 128-bit digest and
stand for one another as their smallest key from then on. Sets meet in a bucket when all
values of a band agree. In a bucket the pairs with its hub are candidates, which are
confirmed on the full sets. Buckets whose members are in one component by then are done. In
the others the members are compared in blocks of bounded size: no pair is made there but
the links that full sets confirm, and no link between different sets of a bucket is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from postloom.llm.common import HashedWords, bitmap_of, in_bitmap, mixed, pick, released
from postloom.llm.components import connected_components
from postloom.session import materialise

SHINGLE = 5
# At similarity 0.8 a pair meets in none of the bands with probability 5e-5, at 0.85 with 4e-7.
BANDS, ROWS = 25, 5
BINS = BANDS * ROWS
_ATTEMPTS = 1024
# Where an empty bin looks for a value: a fixed random sequence of bins for each bin.
DONORS = (mixed(np.arange(1, BINS * _ATTEMPTS + 1, dtype=np.uint64)) % np.uint64(BINS)).astype(np.int64).reshape(BINS, _ATTEMPTS)
# Sets of a bucket that are compared at once.
BLOCK = 256
FOLD = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str, words: HashedWords, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text, A-Z in lower case.

    Words are separated by ASCII white space. Fewer words than a shingle are one shingle.
    """
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    ids = np.fromiter(map(words.__getitem__, parts), np.uint64, len(parts))
    width = min(size, len(parts))
    last = len(parts) - width + 1
    folded = ids[:last].copy()
    for k in range(1, width):
        folded *= FOLD
        folded += ids[k:last + k]
    return np.unique(mixed(folded + np.uint64(width)))


def signature(sorted_hashes: np.ndarray) -> np.ndarray:
    """One-permutation signature: the smallest hash of each bin, empty bins densified.

    An empty bin copies the first filled bin of its own random sequence, so two sets copy
    from the same place wherever their filled bins agree.
    """
    bins = ((sorted_hashes >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    first = np.searchsorted(bins, np.arange(BINS))
    filled = (first < len(bins)) & (bins[np.minimum(first, len(bins) - 1)] == np.arange(BINS))
    values = np.zeros(BINS, dtype=np.uint64)
    values[filled] = sorted_hashes[first[filled]]
    empty = np.flatnonzero(~filled)
    for attempt in range(_ATTEMPTS):
        if not len(empty):
            break
        donor = DONORS[empty, attempt]
        found = filled[donor]
        values[empty[found]] = values[donor[found]]
        empty = empty[~found]
    if len(empty):
        values[empty] = values[np.flatnonzero(filled)[0]]
    return values


def band_keys(sorted_hashes: np.ndarray) -> np.ndarray:
    """A 64-bit bucket key per band."""
    rows = signature(sorted_hashes).reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        key = mixed(key * FOLD + rows[:, r])
    return key


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = HashedWords()
    for batch in released(batches):
        counts, high, low, bands = [], [], [], []
        for value in batch.column("text"):
            found = shingles(value.as_py() or "", words)
            counts.append(len(found))
            if len(found):
                pair = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), dtype="<i8")
                high.append(int(pair[0]))
                low.append(int(pair[1]))
                bands.append(band_keys(found).view(np.int64))
            else:
                high.append(None)
                low.append(None)
                bands.append(np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array(counts, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
            ["key", "n", "high", "low", "bands"])


def _full_sets(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``(key, hashes)``: full shingle sets of the rows whose key is in ``keys``.

    A fixed-size bitmap drops other rows where they are read; the few that pass by chance
    leave in the join with the pairs.
    """
    bitmap = rows.sparkSession.sparkContext.broadcast(bitmap_of(F.xxhash64("key"), keys))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = HashedWords()
        for batch in released(batches):
            member = in_bitmap(bitmap.value, np.asarray(batch.column("hash")).view(np.uint64))
            chosen = batch.filter(pa.array(member))
            hashes = [shingles(value.as_py() or "", words).tobytes() for value in chosen.column("text")]
            yield pa.RecordBatch.from_arrays([chosen.column("key"), pa.array(hashes, pa.binary())], ["key", "hashes"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.filter(F.col("key").isNotNull()).select("key", "text", F.xxhash64("key").alias("hash")).mapInArrow(sets, f"key {kind}, hashes binary")


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two full sets, sorted, reach the similarity."""
    both = np.concatenate([x, y])
    both.sort(kind="stable")  # merges two sorted runs
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``(a, b)`` whose full sets are similar enough."""
    kind = pairs.schema["a"].dataType.simpleString()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            sides = zip(batch.column("hashes_a"), batch.column("hashes_b"))
            similar = [_similar(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent) for x, y in sides]
            yield batch.select(["a", "b"]).filter(pa.array(similar, pa.bool_()))

    left, right = sets.select(F.col("key").alias("a"), F.col("hashes").alias("hashes_a")), sets.select(F.col("key").alias("b"), F.col("hashes").alias("hashes_b"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "hashes_a", "hashes_b").mapInArrow(compare, f"a {kind}, b {kind}").distinct()


def _may_be_similar(n: Column, m: Column, percent: int) -> Column:
    """Sets of such sizes can reach the similarity."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """``(key, n_shingles, component_id, kept)``, one row per input row.

    Links texts whose sets of SHINGLE-word shingles have a Jaccard similarity of at least
    ``percent`` / 100 (80 or more, see BANDS); ``component_id`` is the smallest key that
    links reach, ``kept`` marks the row that has it. A text without words, or null, is
    linked with nothing. Rows that repeat a key are one document, linked if any of its
    texts is. A row without key stays alone: no component, kept. Other columns are left
    out. Intermediate tables go to the shared folder.
    """
    if percent < 80:
        raise ValueError("the bands are laid out for similarities of 80 percent or more")
    rows = pick(df, key=key, text=text)
    kind = rows.schema["key"].dataType.simpleString()
    digests = materialise(rows.mapInArrow(_digest, f"key {kind}, n bigint, high bigint, low bigint, bands array<bigint>"), "shingle-digests")
    linkable = F.col("key").isNotNull() & (F.col("n") > 0)
    # Only sets that occur more than once are joined, from a table, so that Spark can split a
    # set with very many copies over tasks.
    copied = digests.filter(linkable).groupBy("high", "low").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("rows")).filter("rows > 1").drop("rows")
    known = digests.filter(linkable).join(materialise(copied, "copied-sets"), ["high", "low"], "left").withColumn("set", F.coalesce("first", "key"))
    members = materialise(known.select("key", "n", "set", F.when(F.col("key") == F.col("set"), F.col("bands")).alias("bands")), "set-members")

    links = _links(rows, members, percent)
    component = F.coalesce("component", "set")
    together = members.select("key", "n", "set").join(connected_components(links).withColumnRenamed("node", "set"), "set", "left").select(
        "key", F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("key") == component).alias("kept"))
    alone = digests.filter(~linkable).select("key", F.col("n").alias("n_shingles"), F.col("key").alias("component_id"), F.lit(True).alias("kept"))
    return together.unionByName(alone).withColumnRenamed("key", key)


def _links(rows: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Confirmed links ``(a, b)`` between sets, enough of them to connect all similar sets."""
    entries = members.filter(F.col("bands").isNotNull()).select("set", "n", F.explode("bands").alias("bucket"))
    sizes = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("set").alias("low"), F.max("set").alias("high")).filter("low <> high")
    shared = materialise(entries.join(sizes.select("bucket", "size"), "bucket").select("bucket", "set", "n", "size").distinct(), "bucket-members")
    # Sets that meet many others come first as hubs: the original of many edited copies is
    # similar to all of them while they need not be similar to one another.
    fame = shared.groupBy("set").agg(F.sum("size").alias("fame"))
    shared = materialise(shared.drop("size").join(fame, "set"), "bucket-fame")
    sets = materialise(_full_sets(rows, fame.select(F.col("set").alias("key"))), "full-sets")
    hubs = shared.groupBy("bucket").agg(F.max(F.struct("fame", "set", "n")).alias("h")).select("bucket", F.col("h.set").alias("hub"), F.col("h.n").alias("n_hub"))
    star = shared.join(hubs, "bucket").filter((F.col("set") != F.col("hub")) & _may_be_similar(F.col("n"), F.col("n_hub"), percent))
    pairs = materialise(star.select(F.least("hub", "set").alias("a"), F.greatest("hub", "set").alias("b")).distinct(), "candidate-pairs")
    links = materialise(_confirmed(pairs, sets, percent), "star-links")

    labels = connected_components(links).withColumnRenamed("node", "set")
    labelled = shared.join(labels, "set", "left").select("bucket", "set", F.coalesce("component", "set").alias("component"))
    several = labelled.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
    # A bucket of two sets is done: one of them was the hub.
    open_buckets = labelled.join(several.filter("size > 2").select("bucket", "size"), "bucket")
    return links.unionByName(materialise(_block_links(open_buckets, sets, percent), "block-links"))


def _block_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` that join components within the buckets ``(bucket, size, set, component)``.

    A bucket is dealt out to blocks of about BLOCK sets, and each two of its blocks meet in
    a group of their own, so a group is bounded however large a bucket is.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("set", "bucket"), blocks).cast("int")
    dealt = members.select("bucket", "set", "component", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    placed = dealt.select("bucket", "set", "component", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    kind = members.schema["set"].dataType.simpleString()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, group = None, []
        for batch in released(batches):
            found: list = []
            for bucket, low, high, own, key, component, hashes in zip(*(batch.column(c) for c in ("bucket", "low", "high", "own", "set", "component", "hashes"))):
                here = (bucket.as_py(), low.as_py(), high.as_py())
                if here != place:
                    found += _group_links(group, percent)
                    place, group = here, []
                group.append((own.as_py() == here[1], own.as_py() == here[2], key.as_py(), component.as_py(), np.frombuffer(hashes.as_py(), np.uint64)))
            yield _pair_batch(found, batch.schema.field("set").type)
        if group:
            yield _pair_batch(_group_links(group, percent), batch.schema.field("set").type)

    met = placed.join(sets.withColumnRenamed("key", "set"), "set").repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    return met.mapInArrow(compare, f"a {kind}, b {kind}").distinct()


def _pair_batch(pairs: list, kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], kind), pa.array([p[1] for p in pairs], kind)], ["a", "b"])


def _group_links(group: list, percent: int) -> list[tuple]:
    """Confirmed links between the two blocks of a group, ``(in first, in second, key, component, hashes)``.

    Pairs of one component are passed over, as are pairs that a link of this group has
    joined, pairs of unlike sizes, and pairs whose signatures agree in fewer bins than six
    standard deviations below what the similarity makes expect.
    """
    root: dict = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    share = percent / 100
    least = int(BINS * (share - 6 * (share * (1 - share) / BINS) ** 0.5))
    signatures = np.stack([signature(member[4]) for member in group]) if group else None
    sizes = np.array([len(member[4]) for member in group])
    second = np.array([member[1] for member in group], dtype=bool)
    same = any(member[0] and member[1] for member in group)
    found = []
    for i, (in_first, _, key, component, hashes) in enumerate(group):
        if not in_first:
            continue
        likely = second & (100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i])) & ((signatures == signatures[i]).sum(axis=1) >= least)
        if same:
            likely[:i + 1] = False
        for j in np.flatnonzero(likely).tolist():
            _, _, other, other_component, other_hashes = group[j]
            mine, theirs = find(component), find(other_component)
            if mine != theirs and key != other and _similar(hashes, other_hashes, percent):
                root[mine] = theirs
                found.append((min(key, other), max(key, other)))
    return found


def drop_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose ``key`` is not in ``keys (key)``; null keys stay.

    Wide rows whose key is surely not among ``keys`` pass from scan to result: a
    fixed-size bitmap tells. Only the others are shuffled to the exact anti-join.
    """
    bitmap = df.sparkSession.sparkContext.broadcast(bitmap_of(F.xxhash64("key"), keys))

    @F.pandas_udf("boolean")
    def maybe(hashes: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(bitmap.value, hashes.to_numpy(dtype=np.int64).view(np.uint64)))

    names = df.columns
    numbered = df.toDF(*[f"_{i}" for i in range(len(names))])
    own = F.col(f"_{names.index(key)}")
    marked = numbered.withColumn("_maybe", own.isNotNull() & maybe(F.xxhash64(own)))
    open_rows = marked.filter("_maybe").drop("_maybe")
    kept = open_rows.join(keys.select(F.col("key").alias("_key")).distinct(), own == F.col("_key"), "left_anti")
    return marked.filter("NOT _maybe").drop("_maybe").unionByName(kept).toDF(*names)


def drop_near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """The documents without those that repeat another: of each component its first key stays.

    The columns are those of ``df``. Rows that repeat a key are one document and stay or
    go together.
    """
    gone = materialise(near_duplicates(df, key, text, percent).filter("NOT kept").select(F.col(key).alias("key")), "near-duplicates")
    return drop_keys(df, gone, key)
