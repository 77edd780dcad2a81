import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from postloom.llm import language_id as li

WORDS = {
    "en": "the of and to in is that was for with on as by this from have not are which were".split(),
    "de": "der die und das nicht mit ein auf für sich von dem auch nach über einer werden".split(),
    "fr": "le la les des une dans est pour que qui avec sur pas plus aux être cette nous".split(),
    "es": "el los las una para con por como más pero sus este también entre cuando ser desde".split(),
    "xx": "zq qz xqz zzq kqx qkx xzk".split(),
}


def corpus(n, seed=1):
    rng = random.Random(seed)
    languages = sorted(WORDS)
    return [(i, " ".join(rng.choices(WORDS[languages[i % 5]], k=rng.randint(4, 40))), languages[i % 5]) for i in range(n)]


def test_held_out_accuracy(spark):
    df = spark.createDataFrame(corpus(800), "doc_id long, text string, lang string")
    model = li.fit_languages(df)
    assert model.families == {"germanic": ["de", "en"], "romance": ["es", "fr"], "xx": ["xx"]}
    found = li.predict_languages(df, model).join(df, "doc_id").withColumn("held_out", li.held_out(F.col("doc_id")))
    share = found.groupBy("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.min("score").alias("low"), F.max("score").alias("high")).collect()
    assert len(share) == 2 and all(r["right"] > 0.98 and 0 <= r["low"] <= r["high"] <= 1 for r in share)


def test_held_out_rows_and_inputs_do_not_matter(spark):
    rows = corpus(300)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = {r["doc_id"] for r in df.filter(li.held_out(F.col("doc_id"))).collect()}
    changed = [(i, "other words" if i in held else t, "de" if i in held else l) for i, t, l in rows]
    a, b = li.fit_languages(df), li.fit_languages(spark.createDataFrame(changed, "doc_id long, text string, lang string").repartition(4))
    assert np.array_equal(a.family_weights, b.family_weights) and all(np.array_equal(a.pair_weights[p], b.pair_weights[p]) for p in a.pair_weights)
    assert li.fit_languages(df, training_rows=50).families == a.families


def test_edges(spark):
    model = li.fit_languages(spark.createDataFrame(corpus(200), "doc_id long, text string, lang string"))
    rows = [(1, None, 3), (2, "", 3), (3, "12 !? ½ ..", 3), (4, "the " * 60_000, 3), (4, "the of and", 3), (None, "les des une", 3), (5, "x", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang_pred int")
    found = [(r["doc_id"], r["lang_pred"], r["score"] == 0) for r in li.predict_languages(df, model).collect()]
    assert found[:4] == [(1, "und", True), (2, "und", True), (3, "und", True), (4, "en", False)] and found[5][1] == "fr" and len(found) == 7
    kept = li.keep_identified(df, model)
    assert kept.columns == df.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 4, 4, 5]
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    nothing = li.fit_languages(empty)
    assert li.predict_languages(empty, nothing).collect() == [] and nothing.predict(li.features("the")) == ("und", 0.0)
    unlabelled = spark.createDataFrame([(1, "the", None), (None, "der", "de"), (3, None, "fr")], "doc_id long, text string, lang string")
    assert set(li.fit_languages(unlabelled).families) <= {"germanic"}


def test_machines_separate():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 10))
    y = np.where(x[:, 0] + 0.5 * x[:, 1] > 0, 1.0, -1.0)
    w = li.linear_machine(x, y)
    assert (np.sign(x @ w[:-1] + w[-1]) == y).mean() > 0.97


def test_features_of_blocks(monkeypatch):
    text = "Wort für Wort " * 50
    whole = li.features(text)
    assert whole == pytest.approx(li.features(text.upper())) and (whole ** 2).sum() == pytest.approx(1)
    monkeypatch.setattr(li, "BLOCK_CHARS", 100)
    assert np.abs(li.features(text) - whole).max() < 0.1
