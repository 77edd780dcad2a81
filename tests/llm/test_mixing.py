import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from postloom.llm import mixing


def corpus(seed=1, n=600):
    rng = random.Random(seed)
    plain = [f"w{i}" for i in range(200)]
    docs, labels = [], []
    for i in range(n):
        domain = rng.choices(mixing.DOMAINS, [8, 2, 1])[0]
        words = rng.choices(plain, k=rng.randint(5, 80))
        if domain == "toxic":
            words += rng.choices(["vile", "nasty", "awful"], k=3)
        if domain == "poor":
            words = [w + "%%%" for w in words]
        rng.shuffle(words)
        docs.append((i, " ".join(words)))
        if i % 2:
            labels.append((i, 0 if domain == "poor" else 1, int(domain == "toxic")))
    return docs, labels


def frames(spark, docs, labels):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def best_rates(tokens, p, targets, ridge=mixing.RATE_RIDGE, steps=60_000):
    """The same problem by accelerated projected gradient on the rates themselves, with restarts."""
    available = (tokens[:, None] * p).sum(axis=0)
    used = available > 0
    rate = ahead = np.ones(len(tokens))
    t = 1.0
    for _ in range(steps):
        error = np.where(used, ((ahead * tokens) @ p - targets) / np.where(used, available, 1), 0)
        new = np.maximum(0, ahead - (p @ error + ridge * (ahead - 1)) / (1 + ridge))
        if ((ahead - new) * tokens) @ (new - rate) > 0:
            t = 1.0
        t_new = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead, moved, t = new + (t - 1) / t_new * (new - rate), np.abs(new - rate).max(), t_new
        rate = new
        if moved < 1e-12:
            break
    return rate


@pytest.mark.parametrize("weights, epochs", [({"good": 0.8, "poor": 0.2, "toxic": 0.0}, 1.1), ({"good": 0.5, "poor": 0.3, "toxic": 0.2}, 1.0), ({"poor": 1.0}, 2.0)])
def test_rates_are_the_best(spark, weights, epochs):
    docs, labels = frames(spark, *corpus())
    rows, mixture = mixing.mix(docs, labels, weights, epochs=epochs)
    data = rows.toPandas()
    tokens, p = data["n_tokens"].to_numpy(float), np.array(data["p"].tolist())
    assert p.sum(axis=1) == pytest.approx(1) and set(mixture.model.words) >= {"vile", "nasty", "awful", "%%%"}
    assert (data["rate"] >= 0).all() and mixture.converged and mixture.steps < 40
    assert data["rate"].to_numpy() == pytest.approx(best_rates(tokens, p, np.array(mixture.targets)), abs=1e-4)
    reached = (data["rate"].to_numpy() * tokens) @ p
    assert reached == pytest.approx(mixture.reached, rel=1e-6, abs=1e-3)
    assert mixture.distances == pytest.approx((reached - mixture.targets) / np.array(mixture.available), abs=1e-6)
    lead = max(weights, key=weights.get)
    at = mixing.DOMAINS.index(lead)
    assert mixture.targets[at] == pytest.approx(epochs * mixture.available[at])


def test_reachable_targets_are_met(spark):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.3, 0.3, 0.3], 400)
    members = spark.createDataFrame([(i, int(n), row.tolist()) for i, (n, row) in enumerate(zip(rng.integers(1, 5000, 400), p))], "key long, n_tokens long, p array<double>")
    mixture = mixing.fit_rates(members, {"good": 0.6, "poor": 0.3, "toxic": 0.1}, mixing.DomainModel(mixing.DOMAINS, [0.0] * 3))
    assert mixture.converged and max(map(abs, mixture.distances)) < 2e-3
    # Posteriors that are all alike reach one mixture only, and the distances tell.
    same = members.withColumn("p", F.array(F.lit(0.5), F.lit(0.3), F.lit(0.2)))
    apart = mixing.fit_rates(same, {"good": 0.1, "poor": 0.1, "toxic": 0.8}, mixing.DomainModel(mixing.DOMAINS, [0.0] * 3))
    assert apart.converged and max(map(abs, apart.distances)) > 0.1


def test_look_up_equals_comparing_all_forms(spark):
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdeä", k=rng.randint(1, 9))) for _ in range(3000)] + ["!" * k for k in range(1, 9)] + ["*" * k for k in range(1, 9)]
    starts = [w[:n] + "*" for n in mixing.BEGINNINGS for w in rng.sample(words, 40) if len(w) > n]
    known = sorted({*rng.sample(words, 60), *starts, "****", "*****", "!!!!*"})
    frame = spark.createDataFrame([(words,), (None,), ([],)], "words array<string>")
    got = [r["v"] for r in frame.select(mixing.looked_up(F.col("words"), {w: i for i, w in enumerate(known)}, "int").alias("v")).collect()]
    forms = [f for w in words for f in (w, *[w[:n] + "*" for n in mixing.BEGINNINGS if len(w) > n])]
    assert sorted(got[0]) == sorted(known.index(f) for f in forms if f in set(known)) and not got[1] and not got[2]


def test_posteriors_follow_the_labels(spark):
    docs, labels = frames(spark, *corpus(2))
    model = mixing.fit_domains(docs, labels)
    judged = mixing.memberships(docs, model).join(labels, F.col("key") == F.col("doc_id")).withColumn("domain", mixing.label_domain(F.col("quality"), F.col("toxic")))
    best = judged.select("domain", F.array_position("p", F.array_max("p")).alias("at")).toPandas()
    assert (best["at"] == best["domain"].map({d: i + 1 for i, d in enumerate(mixing.DOMAINS)})).mean() > 0.97


def test_copies_of_one_text_count_once(spark):
    """A third of all rows are one long good text: its words must not stand for the good domain."""
    docs, labels = corpus(5, 1000)
    domains = {i: "toxic" if t else "good" if q else "poor" for i, q, t in labels}
    copy = " ".join(f"copied{i}" for i in range(400))
    copies = [(10_000 + i, copy.upper() if i % 3 else copy + "  .") for i in range(500)]
    model = mixing.fit_domains(*frames(spark, docs + copies, labels + [(i, 1, 0) for i, _ in copies[:200]]))
    judged = mixing.memberships(frames(spark, docs + copies[:1], labels)[0], model).collect()
    best = {r["key"]: mixing.DOMAINS[r["p"].index(max(r["p"]))] for r in judged}
    assert not [w for w in model.words if w.startswith("copied")]
    for domain in mixing.DOMAINS:
        assert np.mean([best[i] == domain for i, d in domains.items() if d == domain]) > 0.95
    assert best[10_000] == "good"


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_toxic_recall_in_every_language(spark, sf):
    """Rare languages have few labelled rows, and their toxic words are inflected."""
    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    marked = docs.join(labels, "doc_id").withColumn("domain", mixing.label_domain(F.col("quality"), F.col("toxic")))
    judged = mixing.memberships(docs, mixing.fit_domains(docs, labels)).join(marked.select(F.col("doc_id").alias("key"), "lang", "domain"), "key")
    best = judged.select("lang", "domain", (F.array_position("p", F.array_max("p")) == 3).alias("found")).toPandas()
    toxic = best[best["domain"] == "toxic"].groupby("lang")["found"].mean()
    assert set(toxic.index) == {"en", "de", "fr", "es"} and (toxic > 0.85).all(), toxic
    assert best[best["domain"] == "good"]["found"].mean() < 0.01


def test_infeasible_and_wrong_targets(spark):
    members = spark.createDataFrame([(1, 10, [0.5, 0.5, 0.0]), (2, 30, [0.5, 0.5, 0.0])], "key long, n_tokens long, p array<double>")
    model = mixing.DomainModel(mixing.DOMAINS, [0.0, 0.0, 0.0])
    mixture = mixing.fit_rates(members, {"good": 1.0, "poor": 0.0}, model)
    rates = [r["r"] for r in members.withColumn("r", mixture.rate(F.col("p"))).collect()]
    assert rates == pytest.approx([0.5, 0.5], abs=0.01) and mixture.converged  # the least-squares point between 20 and 0
    for wrong in ({}, {"good": -1.0}, {"nothing": 1.0}, {"good": 0.0}):
        with pytest.raises(ValueError):
            mixing.fit_rates(members, wrong, model)


def test_copies_are_drawn_by_the_rate(spark):
    rows = spark.range(20_000).select("id", mixing.drawn_copies(F.lit(1.3), F.col("id")).alias("c"), mixing.drawn_copies(F.lit(0.0), F.col("id")).alias("z"))
    counts = rows.groupBy("c").count().toPandas().set_index("c")["count"]
    assert set(counts.index) == {1, 2} and 0.28 < counts[2] / 20_000 < 0.32 and rows.agg(F.max("z")).first()[0] == 0


def test_resample_keeps_columns_and_good_documents(spark):
    docs, labels = corpus(3)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, p string, _copies int")
    _, mixture = mixing.mix(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {"good": 0.9, "poor": 0.1, "toxic": 0.0}, 1.05)
    taken = mixing.resample(df, mixture)
    assert taken.columns == df.columns
    left = {r["doc_id"] for r in taken.collect()}
    toxic = {i for i, t in docs if "vile" in t or "nasty" in t or "awful" in t}
    good = {i for i, t in docs if i not in toxic and "%%%" not in t}
    assert not left & toxic and good <= left


def test_edges(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 1), (None, 0, 0), (3, 0, None)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(1, "a b", 1), (1, "a b", 1), (2, None, 1), (None, "", 1), (4, "w " * 100_000, 1)], "doc_id long, text string, n_tokens int")
    rows, _ = mixing.mix(docs, labels, {"good": 1.0})
    assert sorted((r["key"] or 0, r["n_tokens"]) for r in rows.collect()) == [(0, 0), (1, 2), (1, 2), (2, 0), (4, 100_000)]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    equal, _ = mixing.mix(docs, none, {"good": 1.0})
    assert all(r["p"] == pytest.approx([1 / 3] * 3) for r in equal.collect())
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert mixing.mix(empty, labels, {"good": 1.0})[0].collect() == [] and mixing.resample(empty, mixing.mix(empty, none, {"good": 1.0})[1]).collect() == []


def test_main_path_is_native(spark, plan):
    docs, labels = frames(spark, *corpus(4, 60))
    rows, mixture = mixing.mix(docs, labels, {"good": 1.0})
    for df in (rows, mixing.memberships(docs, mixture.model), mixing.resample(docs, mixture)):
        text = plan(df)
        assert "EvalPython" not in text and "MapInArrow" not in text
    assert math.isclose(sum(mixture.targets), mixture.targets[0])
