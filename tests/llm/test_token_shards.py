import json

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from postloom.llm import token_shards as ts
from postloom.llm.queries import VOCABULARY
from postloom.session import fresh_path

RANKS = ts.read_ranks(VOCABULARY)
ENCODER = ts.Encoder(RANKS)
PLAIN = tiktoken.Encoding("plain", pat_str=ts.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100, 1000, 4097])
def test_permutations_are_bijections(size):
    images = {key: ts.Permutation(size, key)(np.arange(size, dtype=np.uint64)).tolist() for key in (0, 1, 2**70)}
    for image in images.values():
        assert sorted(image) == list(range(size))
    if size >= 100:
        assert images[0] != images[1] != list(range(size))


def test_permutation_of_a_large_range():
    values = np.arange(10_000, dtype=np.uint64) * np.uint64(10**14)
    images = ts.Permutation(10**18 + 7, 5)(values)
    assert len(set(images.tolist())) == 10_000 and int(images.max()) < 10**18 + 7
    with pytest.raises(ValueError):
        ts.Permutation(1 << 63, 1)


TEXTS = st.lists(st.sampled_from(["a", "Hello", " ", "  ", "\n", "\t", ".", "'s", "é", "12", " ", "!!", "日本", "\r\n"]), max_size=20).map("".join)


@settings(max_examples=300, deadline=None)
@given(TEXTS | st.text(max_size=30))
def test_words_encode_as_the_whole_text(text):
    assert np.frombuffer(ENCODER(text), ENCODER.dtype).tolist() == PLAIN.encode_ordinary(text) + [ENCODER.end]


DOCS = [(i, f"Text number {i} " * (i % 40)) for i in range(120)] + [(500, None), (501, ""), (7, "again"), (7, "again"), (None, "no key"), (900, "long " * 30_000)]


def test_round_trip(spark):
    path = fresh_path(spark, "shards")
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in DOCS], "doc_id long, text string, slot int, shard int")
    ts.write_training_order(df, path, RANKS, sequence_tokens=16, permutation_key=3, shard_octets=20_000)
    rows = sorted(ts.read_training_order(spark, path).collect(), key=lambda r: r["slot"])
    assert [r["slot"] for r in rows] == list(range(len(rows)))
    expected = []
    for key, text in DOCS:
        data = ENCODER(text or "")
        expected += [(key, s, data[o:o + 32]) for s, o in enumerate(range(0, len(data), 32))]
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(((r["key"], r["seq"], bytes(r["tokens"])) for r in rows), key=order) == sorted(expected, key=order)
    assert all(r["n_tokens"] * 2 == len(r["tokens"]) for r in rows)
    manifest = ts.read_manifest(path)
    assert len(manifest["shards"]) > 5 and manifest["records"] == len(rows)
    # Reads resume at any slot; the order does not depend on partitions, but on the key.
    tail = sorted(ts.read_training_order(spark, path, start=1000).collect(), key=lambda r: r["slot"])
    assert tail == rows[1000:]
    again, other = fresh_path(spark, "shards"), fresh_path(spark, "shards")
    ts.write_training_order(df.repartition(5), again, RANKS, 16, 3, shard_octets=20_000)
    assert sorted(ts.read_training_order(spark, again).collect(), key=lambda r: r["slot"]) == rows
    ts.write_training_order(df, other, RANKS, 16, 4, shard_octets=20_000)
    assert [r["key"] for r in sorted(ts.read_training_order(spark, other).collect(), key=lambda r: r["slot"])] != [r["key"] for r in rows]


def test_empty(spark):
    path = fresh_path(spark, "shards")
    ts.write_training_order(spark.createDataFrame([], "doc_id long, text string"), path, RANKS)
    assert ts.read_manifest(path)["records"] == 0 and ts.read_training_order(spark, path).collect() == []


def test_null_and_repeated_keys_spread(spark):
    docs = [(None, f"text {i}") for i in range(300)] + [(5, f"other {i}") for i in range(300)] + [(k, "x") for k in (6, -(1 << 62), (1 << 62) + 5)]
    path = fresh_path(spark, "shards")
    ts.write_training_order(spark.createDataFrame(docs, "doc_id long, text string"), path, RANKS, sequence_tokens=16, shard_octets=500)
    shards = ts.read_manifest(path)["shards"]
    assert sum(s["records"] for s in shards) == len(docs) and len(shards) >= 10 and max(s["records"] for s in shards) < len(docs) / 4
    again = fresh_path(spark, "shards")
    ts.write_training_order(spark.createDataFrame(docs[::-1], "doc_id long, text string").repartition(3), again, RANKS, sequence_tokens=16, shard_octets=500)
    assert sorted(ts.read_training_order(spark, again).collect()) == sorted(ts.read_training_order(spark, path).collect())


def test_the_driver_starts_no_python_planners(spark, monkeypatch, plan):
    """Spark plans and commits Python data sources in processes beside the driver, which keep their memory."""
    register = type(spark.dataSource).register

    def refused(self, source):
        raise AssertionError("a data source was registered")

    monkeypatch.setattr(type(spark.dataSource), "register", refused)
    path, copy = fresh_path(spark, "shards"), fresh_path(spark, "shards")
    df = spark.createDataFrame(DOCS, "doc_id long, text string")
    ts.write_training_order(df, path, RANKS, sequence_tokens=16, shard_octets=20_000)
    rows = ts.read_training_order(spark, path)
    assert "BatchScan" not in plan(rows) and rows.rdd.getNumPartitions() == len(ts.read_manifest(path)["shards"])
    # The data source has the same rows and writes the same files.
    monkeypatch.setattr(type(spark.dataSource), "register", register)
    spark.dataSource.register(ts.TokenShards)
    for start in (0, 700):
        assert sorted(spark.read.format(ts.FORMAT).option("start", str(start)).load(path).collect()) == sorted(ts.read_training_order(spark, path, start).collect())
    sequences, layout = ts.placed_sequences(df, RANKS, 16, 1, shard_octets=20_000)
    ordered = sequences.repartitionById(layout.shards, F.col("shard")).sortWithinPartitions("place", "key", "seq", "tokens")
    ordered.write.format(ts.FORMAT).mode("append").option("layout", json.dumps(vars(layout))).save(copy)
    assert ts.read_manifest(copy) == ts.read_manifest(path)
    assert sorted(ts.read_training_order(spark, copy).collect()) == sorted(rows.collect())
