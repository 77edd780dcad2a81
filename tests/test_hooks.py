from postloom import hooks
from postloom.functions import language as L
from postloom.operators.stats import budget_tokens


def counting_tokenizer(calls):
    class Words:
        def encode(self, text):
            calls.add(1)
            return text.split(" ")

        def decode(self, tokens):
            return " ".join(tokens)

    return lambda: Words()


def test_a_budget_encodes_each_text_once(spark, plan):
    calls = spark.sparkContext.accumulator(0)
    rows = [(i, None if i % 10 == 3 else " ".join(["w"] * (i % 7 + 1)), "kept") for i in range(700)]
    df = spark.createDataFrame(rows, "id int, text string, other string").coalesce(1)
    budget = budget_tokens(df, 3, tokenizer=counting_tokenizer(calls))
    assert plan(budget).split("(1) ")[0].count("EvalPython") == 1
    found = budget.collect()
    assert calls.value == sum(t is not None for _, t, _ in rows) and budget.columns == ["id", "text", "other", "n_tokens", "truncated"]
    for (i, text, _), row in zip(rows, sorted(found, key=lambda r: r["id"]), strict=True):
        words = None if text is None else text.split(" ")
        assert tuple(row) == (i, None, "kept", None, None) if words is None else tuple(row) == (i, " ".join(words[:3]), "kept", len(words), len(words) > 3)


def test_stemmers_share_a_worker_and_see_different_words(spark, plan):
    calls = spark.sparkContext.accumulator(0)

    def upper():
        def stem(word):
            calls.add(1)
            return word.upper()

        return stem

    rows = [(i, ["en", "de", "fr", None, "es"][i % 5], None if i % 11 == 0 else ["casas"] * (i % 4)) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, lang string, tokens array<string>").coalesce(1)
    stems = df.select("id", L.stem_tokens("tokens", "lang", {"en": upper, "de": lambda: str.title}).alias("stems"))
    assert plan(stems).split("(1) ")[0].count("EvalPython") == 1
    expected = {"en": "CASAS", "de": "Casas", "es": "cas"}
    for row, (i, lang, tokens) in zip(stems.orderBy("id").collect(), rows, strict=True):
        assert row["stems"] == (None if tokens is None else [expected.get(lang, "casas")] * len(tokens)), i
    calls.value = 0
    stems.collect()
    assert 0 < calls.value <= -(-600 // hooks.SLICE_ROWS)
