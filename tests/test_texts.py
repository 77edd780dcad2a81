import tiktoken
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from postloom import hooks
from postloom.functions.text import clean_text, e5_prefix, posting_text, regex_normalise, section_format, word_count
from postloom.functions.tokens import token_count, truncate_tokens
from postloom.operators.filters import length_gate
from postloom.operators.stats import budget_tokens


def column(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression).collect()]


def test_null_is_spelled_none(spark):
    assert column(spark, [None, "x"], section_format("title", "v")) == ["#### title: None ####", "#### title: x ####"]
    assert column(spark, [None], e5_prefix("v")) == ["query: None"]
    assert column(spark, ["a"], e5_prefix("v", "passage")) == ["passage: a"]


def test_clean_text_removes_four_characters(spark):
    assert column(spark, ["(a), 'b' [c]; d"], clean_text("v")) == ["a b [c]; d"]


def test_posting_text_layout(spark):
    df = spark.createDataFrame([("Dev (m)", None, "It's, fine")], "title string, location string, description string")
    expected = "#### title: Dev m #### #### location: None #### #### description: Its fine ####"
    assert df.select(posting_text()).first()[0] == expected


def test_word_count_follows_str_split(spark):
    texts = ["", "   ", "a", " a  b\tc\n", "a\x1cb", "a　b", "a​b", "a\x85b", "a\xa0b c", " x"]
    assert column(spark, texts, word_count("v")) == [len(t.split()) for t in texts]


def test_normalise_drops_accents_and_digits(spark):
    texts = ["Programación C3: año 2023!", "  ", "Kelvin İx", "A:B\tc"]
    assert column(spark, texts, regex_normalise(F.col("v"))) == ["programaci n c : a o", "", "elvin x", "a:b c"]


def test_length_gate_at_the_border(spark):
    df = spark.createDataFrame([("a " * 50,), ("a " * 51,), ("",)], "text string")
    assert [r["gate"] for r in length_gate(df).collect()] == ["pass", "summarise", "pass"]


def test_budget_at_the_border(spark):
    texts = ["a b c", " a  b\nc ", "a b c d", "  a  b\tc   d e", None, ""]
    rows = budget_tokens(spark.createDataFrame([(t,) for t in texts], "text string"), 3).collect()
    assert [r["text"] for r in rows] == ["a b c", " a  b\nc ", "a b c", "  a  b\tc", None, ""]
    assert [r["truncated"] for r in rows] == [False, False, True, True, None, False]
    assert [r["n_tokens"] for r in rows] == [3, 3, 4, 5, None, 0]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab \n\t", max_size=40), min_size=1, max_size=20), st.integers(1, 5))
def test_truncated_text_is_a_prefix_within_budget(spark, texts, budget):
    cut = column(spark, texts, truncate_tokens("v", budget))
    for text, short in zip(texts, cut):
        assert text.startswith(short)
        assert short == text if len(text.split()) <= budget else len(short.split()) == budget


def byte_tokenizer():
    return tiktoken.Encoding("bytes", pat_str=r"[\s\S]", mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})


def test_tokenizer_hook(spark):
    assert column(spark, ["abcd", None, "é"], token_count("v", byte_tokenizer)) == [4, None, 2]
    assert column(spark, ["abcd", "ab", None], truncate_tokens("v", 3, tokenizer=byte_tokenizer)) == ["abc", "ab", None]
    rows = budget_tokens(spark.createDataFrame([("abcd",), ("ab",)], "text string"), 3, tokenizer=byte_tokenizer).collect()
    assert [(r["text"], r["n_tokens"], r["truncated"]) for r in rows] == [("abc", 4, True), ("ab", 2, False)]


def test_tiktoken_factory_asks_for_the_model(monkeypatch):
    asked = []
    monkeypatch.setattr(tiktoken, "encoding_for_model", lambda model: asked.append(model) or byte_tokenizer())
    assert hooks.tiktoken_tokenizer("some-model")().decode([104, 105]) == "hi" and asked == ["some-model"]
