import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from postloom.llm import minhash
from postloom.llm.common import HashedWords, bitmap_of, in_bitmap, mixed
from postloom.llm.components import connected_components


def shingle_set(text):
    words = [w for w in (text or "").encode().lower().split()]
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def classes(texts, percent):
    """Brute force: every pair, then components, as {key: (size, component)}."""
    sets = [(key, shingle_set(text)) for key, text in texts]
    root = {key: key for key, _ in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {key: (len(s), find(key)) for key, s in sets}


def families(seed, sizes=(40, 25, 8, 3, 2, 2)):
    """Copies of a few originals with up to a fifth of the words changed, and texts of few words."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(3000)]
    texts = []
    for size in sizes:
        original = rng.choices(words, k=rng.choice([12, 40, 150, 400]))
        for _ in range(size):
            copy = list(original)
            for _ in range(rng.randint(0, max(1, len(copy) // 25))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    texts += [" ".join(rng.choices(words, k=rng.randint(1, 9))) for _ in range(20)] + ["one two"] * 3 + ["a b c d e f", "A B c d  e\tf"]
    keys = rng.sample(range(10_000), len(texts))
    return list(zip(keys, texts))


@pytest.mark.parametrize("seed, percent, block", [(1, 85, 256), (2, 85, 4), (3, 80, 5)])
def test_classes_equal_brute_force(spark, monkeypatch, seed, percent, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    texts = families(seed)
    rows = minhash.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string").repartition(3), percent=percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == classes(texts, percent)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_blocks_find_links_that_no_hub_has(spark, monkeypatch):
    """Two texts like each other in a bucket whose hub is like neither."""
    monkeypatch.setattr(minhash, "BLOCK", 2)
    rng = np.random.default_rng(4)
    hub = np.unique(mixed(rng.integers(1, 2**60, 300).astype(np.uint64)))
    near = np.unique(np.concatenate([hub[:200], mixed(rng.integers(1, 2**60, 100).astype(np.uint64))]))
    sets = [(i, s.tobytes()) for i, s in enumerate([hub, near, near[:-5], near[3:], hub[:250]])]
    members = [(7, 5, i, i) for i in range(5)]
    found = minhash._block_links(spark.createDataFrame(members, "bucket long, size long, set long, component long"), spark.createDataFrame(sets, "key long, hashes binary"), 85)
    labels = {r["node"]: r["component"] for r in connected_components(found).collect()}
    assert labels == {1: 1, 2: 1, 3: 1}


def test_edges(spark):
    long_text = "word " * 60_000
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (2, "A B C D E F", "x"), (3, None, "x"), (4, "", "x"), (5, " \t ", "x"), (None, "a b c d e f", "x"), (6, long_text, "x"), (7, long_text, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    found = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(df).collect())
    assert found == [(0, 2, None, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 1, 6, True), (7, 1, 6, False)]
    kept = minhash.drop_near_duplicates(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 1, 3, 4, 5, 6]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(empty).collect() == [] and minhash.drop_near_duplicates(empty).collect() == []
    with pytest.raises(ValueError):
        minhash.near_duplicates(empty, percent=70)


def test_signatures_agree_as_the_similarity():
    rng = np.random.default_rng(1)
    for size in (3, 30, 300):
        shares = []
        for _ in range(200):
            x = mixed(rng.integers(1, 2**62, size).astype(np.uint64))
            y = np.concatenate([x[: size * 2 // 3], mixed(rng.integers(1, 2**62, size - size * 2 // 3).astype(np.uint64))])
            shares.append((minhash.signature(np.unique(x)) == minhash.signature(np.unique(y))).mean())
        assert abs(np.mean(shares) - 0.5) < 0.06


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=14))
def test_components(spark, pairs):
    neighbours = {}
    for a, b in pairs:
        if a != b:
            neighbours.setdefault(a, set()).add(b)
            neighbours.setdefault(b, set()).add(a)
    expected = {}
    for node in neighbours:
        seen, todo = {node}, [node]
        while todo:
            for other in neighbours[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        expected[node] = min(seen)
    found = connected_components(spark.createDataFrame(pairs, "a long, b long"))
    assert {r["node"]: r["component"] for r in found.collect()} == expected


def test_a_long_chain(spark):
    chain = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["component"] for r in connected_components(chain).collect()} == {0}


def test_bitmaps_have_no_false_negatives(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("h"))
    bitmap = bitmap_of(F.col("h"), keys)
    hashes = np.array([r["h"] for r in keys.collect()], dtype=np.int64).view(np.uint64)
    assert in_bitmap(bitmap, hashes).all()
    assert in_bitmap(bitmap, mixed(np.arange(1, 100_001, dtype=np.uint64))).mean() < 0.002


def test_remembered_words_are_bounded():
    words = HashedWords(limit=10)
    assert [words[str(i).encode()] for i in range(50)] == [HashedWords()[str(i).encode()] for i in range(50)] and len(words) <= 10


def test_drop_keys(spark):
    df = spark.createDataFrame([(i, str(i)) for i in range(100)] + [(None, "n"), (3, "again")], "k long, _maybe string")
    left = minhash.drop_keys(df, spark.createDataFrame([(3,), (50,), (None,), (500,)], "key long"), "k").collect()
    assert sorted(r["k"] for r in left if r["k"] is not None) == [i for i in range(100) if i not in (3, 50)] and len(left) == 99
