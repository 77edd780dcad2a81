"""The pipeline's stages, each on what its predecessor kept, against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from postloom.llm import token_shards as ts
from postloom.llm.queries import VOCABULARY
from postloom.session import fresh_path
from tests.llm.test_language_id import WORDS
from tests.llm.test_minhash import classes

TOXIC = ["vile", "nasty", "awful"]


@pytest.fixture(scope="module")
def folder(spark):
    """Documents of four languages with copies, benchmark passages, toxic and empty ones."""
    rng = random.Random(7)
    item = lambda: " ".join(rng.choices(WORDS["en"] + ["river", "stone", "light"], k=25))
    items = [(i, item()) for i in range(6)]
    rows, labels = [], []
    for i in range(260):
        lang = rng.choice(["en", "de", "fr", "es"])
        words = rng.choices(WORDS[lang], k=rng.randint(30, 90)) + [f"n{rng.randrange(10**6)}" for _ in range(12)]
        rng.shuffle(words)
        kind = rng.choices(["plain", "toxic", "leak", "copy", "empty"], [10, 3, 2, 3, 1])[0]
        text = " ".join(words)
        if kind == "toxic":
            text = " ".join(words[:10] + TOXIC + words[10:])
        if kind == "leak":
            text = text + ". " + rng.choice(items)[1]
        if kind == "copy" and rows:
            text = rng.choice(rows)[1] or text
        if kind == "empty":
            text = rng.choice([None, "", "123 !"])
        rows.append((i, text, lang, f"s{i % 3}", len(text or "")))
        if i % 2:
            labels.append((i, 1, int(text is not None and TOXIC[0] in text)))
    path = fresh_path(spark, "small-sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, items


def test_stages(spark, folder):
    path, items = folder
    docs, kept = spark.read.parquet(f"{path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = fresh_path(spark, "stage")
        stage(spark, docs, path).write.parquet(out)
        before, docs = docs, spark.read.parquet(out)
        assert docs.columns == before.columns
        kept.append((name, {r["doc_id"]: r["text"] for r in before.collect()}, [(r["doc_id"], r["text"]) for r in docs.collect()]))
    (_, first, identified), (_, _, unique), (_, _, clean), (_, _, mixed) = kept
    assert dict(identified) == {k: t for k, t in first.items() if t and any(map(str.isalpha, t))} and len(identified) == len(dict(identified))
    found = classes(identified, corpus_pipeline.NEAR_PERCENT)
    assert {k for k, _ in unique} == {c for _, c in found.values()}
    leaks = {k for k, t in unique if any(text in t for _, text in items)}
    assert leaks and {k for k, _ in clean} == {k for k, _ in unique} - leaks
    toxic = {k for k, t in clean if TOXIC[0] in t.split()}
    left = {k for k, _ in mixed}
    assert toxic and left == {k for k, _ in clean} - toxic

    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, path).toPandas()
    assert sorted(tokens["slot"]) == list(range(len(tokens)))
    encoder = ts.Encoder(ts.read_ranks(VOCABULARY))
    assert tokens["n_tokens"].sum() == sum(len(np.frombuffer(encoder(t), encoder.dtype)) for _, t in mixed)


def test_run_is_all_stages(spark, folder):
    rows = corpus_pipeline.run(spark, folder[0])
    assert rows.columns == ["slot", "shard", "doc_id", "seq", "n_tokens", "tokens_crc32"] and rows.count() > 100
    assert rows.agg(F.max("slot") + 1).first()[0] == rows.count()


def test_an_empty_table(spark, folder):
    path = fresh_path(spark, "empty-sf")
    for table in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{folder[0]}/{table}.parquet").limit(0).write.parquet(f"{path}/{table}.parquet")
    assert corpus_pipeline.run(spark, path).collect() == []
