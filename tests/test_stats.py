import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from postloom.functions.money import completion_cost, embedding_cost, round_binary
from postloom.operators.stats import batch_stats, budget_tokens, cost_total, describe_table, location_token_counts


def test_batch_stats(spark):
    texts = spark.createDataFrame([("a b c",), ("a",)], "text string")
    row = batch_stats(budget_tokens(texts, 2), "openai").first()
    assert (row["batches"], row["tokens"], row["truncations"], row["mean_tokens"]) == (2, 4, 1, 2.0)
    assert row["cost"] == round(4 / 1000 * 0.0004, 4)


def test_empty_input_has_no_mean(spark):
    row = batch_stats(budget_tokens(spark.createDataFrame([], "text string"))).first()
    assert tuple(row) == (0, 0, 0, None, 0.0)


def test_unknown_embedding_model():
    with pytest.raises(ValueError):
        embedding_cost("tokens", "other")


def test_rounding_equals_python(spark):
    rng = random.Random(7)
    values = [rng.random() * rng.choice([0.01, 1, 10, 1000]) for _ in range(3000)]
    values += [i * 0.0005 for i in range(3000)] + [i / 1000 * 0.0015 for i in range(0, 300000, 100)] + [2.675, 0.0045, 0.0015]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.select("v", *[round_binary(F.col("v"), d).alias(f"d{d}") for d in (2, 3, 4)]).collect()
    for d in (2, 3, 4):
        assert all(r[f"d{d}"] == round(r["v"], d) for r in rows)


def test_completion_cost_per_part(spark):
    calls = [(3000, 1000, "gpt-3.5-turbo"), (1000, 350, "gpt-3.5-turbo-16k"), (5, 5, "other")]
    df = spark.createDataFrame(calls, "p int, c int, m string")
    prices = {"gpt-3.5-turbo": (0.0015, 0.002), "gpt-3.5-turbo-16k": (0.003, 0.004), "other": (0, 0)}
    expected = [round(p / 1000 * prices[m][0], 3) + round(c / 1000 * prices[m][1], 3) for p, c, m in calls]
    costed = df.select(completion_cost("p", "c", "m").alias("cost"))
    assert [r["cost"] for r in costed.collect()] == expected
    assert cost_total(costed).first()["total_cost"] == pytest.approx(sum(expected))


def described(df, **options):
    return {(r["column"], r["stat"]): r["value"] for r in describe_table(df, **options).collect()}


@pytest.mark.parametrize("accuracy", [20, 100, 1000])
def test_describe_equals_pandas(spark, accuracy):
    rng = np.random.default_rng(3)
    n = 4000
    hot = rng.normal(size=n)
    hot[: n // 3] = 0.25  # one value holds a third of the rows
    data = pd.DataFrame({
        "normal": rng.normal(size=n), "hot": rng.permutation(hot), "heavy": np.exp(rng.normal(size=n) * 8),
        "whole": rng.integers(0, 7, n), "same": np.full(n, 3.5),
    })
    got = described(spark.createDataFrame(data), accuracy=accuracy)
    expected = data.describe()
    for (column, stat), value in got.items():
        assert value == pytest.approx(expected.loc[stat, column], rel=1e-9, abs=1e-12), (column, stat)


def test_describe_edge_cases(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (2.0, None)], "a double, b double")
    got = described(df)
    assert (got["a", "count"], got["a", "50%"], got["a", "25%"]) == (2.0, 1.5, 1.25)
    assert got["b", "count"] == 0.0 and got["b", "mean"] is None and got["b", "50%"] is None
    with pytest.raises(ValueError):
        describe_table(df.select(F.lit("x").alias("s")))


def test_location_tokens(spark):
    df = spark.createDataFrame([("Remote US",), ("US  US Morelia,",), ("",), (None,)], "location string")
    assert [tuple(r) for r in location_token_counts(df).collect()] == [("US", 3), ("Morelia,", 1), ("Remote", 1)]


def test_cost_total_does_not_depend_on_partitions(spark):
    costs = spark.range(100_000).select((F.col("id") % 997 / 1000).alias("cost"))
    totals = {cost_total(costs.repartition(n)).first()["total_cost"] for n in (1, 3, 16)}
    assert totals == {sum(i % 997 for i in range(100_000)) / 1000}
