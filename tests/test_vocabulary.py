import random

import pytest
import tiktoken

from postloom.operators import vocabulary as module
from postloom.operators.vocabulary import PATTERN, build_vocabulary, model_budget, model_token_counts, read_ranks

VOCABULARY = "file:/opt/tokenizers/byte_bpe_50k.tiktoken"
PIECES = ["a", "Hello", " ", "  ", "\n", "\t", ".", "'s", "it's", "é", "12", " ", "!!", "日本語", "\r\n", "unbelievably", "🙂", "x" * 40]


@pytest.fixture(scope="module")
def ranks(spark):
    return read_ranks(spark, VOCABULARY)


def texts():
    rng = random.Random(3)
    return [(i, "".join(rng.choices(PIECES, k=rng.randint(0, 60)))) for i in range(300)] + [(1000, None), (1001, ""), (1002, "long text, " * 20_000)]


@pytest.mark.parametrize("frequent", [3, 50_000])
def test_counts_are_those_of_whole_texts(spark, ranks, frequent):
    encoding = tiktoken.Encoding("whole", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    df = spark.createDataFrame(texts(), "id long, text string").repartition(3)
    counts = {r["id"]: r["n_tokens"] for r in model_token_counts(df, build_vocabulary(df, ranks, frequent=frequent)).collect()}
    assert counts == {i: len(encoding.encode_ordinary(t)) for i, t in texts() if t}


@pytest.mark.parametrize("frequent, budget", [(3, 7), (50_000, 1), (50_000, 25)])
def test_cuts_are_those_of_whole_texts(spark, ranks, frequent, budget):
    encoding = tiktoken.Encoding("whole", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    df = spark.createDataFrame([(*row, "kept") for row in texts()], "id long, text string, other string").repartition(3)
    rows = model_budget(df, build_vocabulary(df, ranks, frequent=frequent), budget).collect()
    assert len(rows) == len(texts()) and rows[0].asDict().keys() == {"id", "text", "other", "n_tokens", "truncated"}
    for row in rows:
        text = dict(texts())[row["id"]]
        if text is None:
            assert row["text"] is None and row["n_tokens"] is None and row["truncated"] is None
            continue
        tokens = encoding.encode_ordinary(text)
        whole = b"".join(encoding.decode_tokens_bytes(tokens[:budget])).decode("utf-8", "ignore")
        assert (row["n_tokens"], row["truncated"], row["other"]) == (len(tokens), len(tokens) > budget, "kept")
        assert row["text"] == (whole if len(tokens) > budget else text)


def test_no_encoder_runs_per_row(spark, ranks, plan):
    df = spark.createDataFrame(texts(), "id long, text string")
    text = plan(model_token_counts(df, build_vocabulary(df, ranks)))
    assert "MapInArrow" not in text and "EvalPython" not in text


def test_ends_of_tokens_are_whole_characters():
    rng = random.Random(5)
    for _ in range(200):
        data = "".join(rng.choices("aé日🙂", k=rng.randint(1, 12))).encode()
        cuts = sorted({0, len(data), *(rng.randint(0, len(data)) for _ in range(6))})
        tokens = [data[a:b] for a, b in zip(cuts, cuts[1:])]
        assert module.whole_ends(data, tokens) == [len(data[:cut].decode("utf-8", "ignore").encode()) for cut in cuts]


def test_budget_counts_once_and_moves_lengths(spark, ranks, monkeypatch):
    plans = {}
    kept = module.materialise

    def recorded(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return kept(df, name)

    monkeypatch.setattr(module, "materialise", recorded)
    df = spark.createDataFrame(texts(), "id long, text string")
    result = model_budget(df, build_vocabulary(df, ranks), 7)
    assert set(plans) == {"vocabulary", "frequent-pieces", "piece-counts", "token-counts", "first-pieces"}
    assert "regexp_extract_all" not in result._jdf.queryExecution().optimizedPlan().toString()
    assert result.filter("truncated").count() > 0
