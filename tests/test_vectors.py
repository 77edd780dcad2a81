import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from postloom.operators.embedding import assemble_embeddings, dimension_check, embed_column, mean_pool
from postloom.operators.ordering import assert_order, chunk_rows, global_rank, order_check
from postloom.operators.search import nearest_postings, query_vector_of


def length_encoder():
    return lambda texts: [[float(len(t)), float(len(texts))] for t in texts]


def test_encoder_hook_gets_chunks_and_each_text_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def factory():
        def encode(texts):
            calls.add(len(texts))
            assert len(texts) <= 4
            return [[float(len(t))] for t in texts]

        return encode

    df = spark.range(10).select("id", F.repeat(F.lit("x"), F.col("id").cast("int")).alias("text")).coalesce(1)
    embedded = embed_column(df, encoder=factory, chunk=4).filter("embedding IS NOT NULL")
    rows = embedded.select("id", F.posexplode("embedding")).collect()
    assert {r["id"]: r["col"] for r in rows} == {i: float(i) for i in range(10)}
    assert calls.value == 10


def test_hashing_encoder(spark):
    df = spark.createDataFrame([("a b a",), ("",), (None,)], "text string")
    first, empty, missing = [r["embedding"] for r in embed_column(df, dim=8).collect()]
    assert sum(v * v for v in first) == pytest.approx(1.0, rel=1e-6)
    assert empty == missing == [0.0] * 8


def test_only_the_model_input_counts(spark, plan):
    df = spark.createDataFrame([("a b " + "c " * 600,)], "text string")
    limited = embed_column(df, dim=8, max_input_tokens=2)
    assert limited.first()["embedding"] == embed_column(spark.createDataFrame([("a b",)], "text string"), dim=8).first()["embedding"]
    assert "EvalPython" not in plan(limited)
    assert embed_column(df, encoder=length_encoder, max_input_tokens=3).first()["embedding"][0] == len("a b c")


def test_assembled_text_has_no_prefix(spark):
    df = spark.createDataFrame([(1, "abc", None)], "id long, text string, timestamp timestamp")
    row = assemble_embeddings(df, encoder=length_encoder).first()
    assert row["job_info"] == "abc" and row["embedding"][0] == len("query: abc")
    assert assemble_embeddings(df, encoder=length_encoder, kind="passage").first()["embedding"][0] == len("passage: abc")


def test_mean_pool_ignores_masked_and_marks_empty(spark):
    tokens = [(1, 1, [1.0, 2.0]), (1, 1, [3.0, 6.0]), (1, 0, [9.0, 9.0]), (2, 0, [5.0, 5.0])]
    df = spark.createDataFrame(tokens, "seq_id int, mask int, vec array<float>")
    pooled = {r["seq_id"]: r["embedding"] for r in mean_pool(df).collect()}
    assert pooled == {1: [2.0, 4.0], 2: [None, None]}


def test_dimension_check(spark):
    df = spark.createDataFrame([([1.0],), ([2.0],), ([1.0, 2.0],)], "embedding array<double>")
    assert {(r["dim"], r["n"]) for r in dimension_check(df).collect()} == {(1, 2), (2, 1)}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 5), min_size=1, max_size=60), st.integers(1, 7))
def test_chunks_are_consecutive(spark, keys, n):
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k int")
    rows = sorted(chunk_rows(df, ["k", "i"], n).collect(), key=lambda r: (r["chunk"], r["idx"]))
    assert [r["i"] for r in rows] == [i for _, i in sorted((k, i) for i, k in enumerate(keys))]
    assert [(r["chunk"], r["idx"]) for r in rows] == [divmod(p, n) for p in range(len(keys))]


def test_equal_keys_spread_over_partitions(spark, plan):
    df = spark.range(0, 4000, 1, 8).select(F.col("id"), F.lit(1).alias("k"))
    ranked = global_rank(df, "k", ranges=8)
    rows = ranked.collect()
    assert sorted(r["rank"] for r in rows) == list(range(1, 4001))
    assert sorted(global_rank(df.repartition(3), "k", ranges=8).collect()) == sorted(rows)
    assert ranked.groupBy(F.spark_partition_id()).count().count() > 1


def test_order_check(spark):
    asked = spark.createDataFrame([(0, 0), (0, 1), (1, 0)], "chunk long, idx int")
    answered = spark.createDataFrame([(0, 0), (0, 1), (0, 1), (2, 0)], "chunk long, idx int")
    problems = {(r["chunk"], r["idx"]): r["problem"] for r in order_check(asked, answered).collect()}
    assert problems == {(0, 1): "repeated", (1, 0): "missing", (2, 0): "unexpected"}
    assert assert_order(asked, asked).count() == 0
    with pytest.raises(PySparkException):
        assert_order(asked, answered).collect()


def brute_force(vectors, queries, k):
    result = []
    for q, query in queries:
        scored = []
        for i, v in vectors:
            scale = np.linalg.norm(v) * np.linalg.norm(query)
            if scale:
                scored.append((-round(float(np.dot(v, query)) / scale, 6), i))
        result += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], start=1)]
    return sorted(result)


@pytest.mark.parametrize("block_bytes", [1 << 20, 7 * 32])
def test_nearest_equals_brute_force(spark, block_bytes):
    rng = np.random.default_rng(5)
    vectors = [(i, v.tolist()) for i, v in enumerate(rng.integers(-2, 3, (300, 4)).astype(float))]  # many ties
    queries = [(q, v.tolist()) for q, v in enumerate(rng.normal(size=(20, 4)))]
    postings = spark.createDataFrame(vectors, "id long, embedding array<double>").repartition(5)
    asked = spark.createDataFrame(queries, "query_id long, embedding array<double>")
    found = nearest_postings(postings, asked, k=6, block_bytes=block_bytes)
    got = sorted((r["query_id"], r["rank"], r["id"], r["score"]) for r in found.collect())
    want = brute_force(vectors, queries, 6)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], atol=2e-6)


def test_nearest_without_queries_or_postings(spark):
    empty = spark.createDataFrame([], "id long, embedding array<double>")
    query = query_vector_of(spark, "a b", dim=4)
    assert nearest_postings(empty, query).count() == 0
    assert nearest_postings(empty, query.limit(0)).count() == 0
