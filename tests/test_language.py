import math

import pytest
from pyspark.sql import functions as F

from postloom.functions import language as L
from postloom.functions.ngrams import NgramLanguages, learn_languages, ngram_language, trigrams
from postloom.operators.lemmas import lemmatise

STEMS = {
    "torneos": "torne", "cheques": "chequ", "chicas": "chic", "chillando": "chill", "absolutamente": "absoluta", "posibilidades": "posibil",
    "trabajadores": "trabaj", "seguridad": "segur", "niñas": "niñ", "aplicación": "aplic", "comer": "com", "vivido": "viv", "sol": "sol",
    "dos": "dos", "ir": "ir", "casa": "cas", "café": "caf",
}


def test_spanish_stems(spark):
    df = spark.createDataFrame([(list(STEMS),)], "t array<string>")
    assert df.select(L.stem_tokens("t", F.lit("es"))).first()[0] == list(STEMS.values())


@pytest.mark.parametrize("word, lemma", [
    ("companies", "company"), ("classes", "class"), ("boxes", "box"), ("women", "woman"), ("status", "status"),
    ("class", "class"), ("skills", "skill"), ("gas", "gas"), ("s", "s"), ("ies", "ies"), ("data", "data"),
])
def test_english_plurals(spark, word, lemma):
    df = spark.createDataFrame([([word],)], "t array<string>")
    assert df.select(L.stem_tokens("t", F.lit("en"))).first()[0] == [lemma]


def test_stems_need_no_python(spark, plan):
    df = spark.createDataFrame([("las casas", "es")], "text string, lang string")
    assert "EvalPython" not in plan(L.normalise_text(df, "text", "lang"))


def test_stop_lists_are_the_shipped_ones(spark):
    from pyspark.ml.feature import StopWordsRemover

    for code, name in L.STOP_LISTS.items():
        assert L.stop_words(code) == StopWordsRemover.loadDefaultStopWords(name)


def test_tokens(spark):
    texts = ["a:b", "a::b c:", "you cannot go", "gonna: wanna", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    assert [r[0] for r in df.select(L.tokenize("t")).collect()] == [
        ["a", ":", "b"], ["a", ":", ":b", "c", ":"], ["you", "can", "not", "go"], ["gon", "na", ":", "wan", "na"], []]


def test_stop_words_keep_repeats_and_other_languages(spark):
    df = spark.createDataFrame([(["the", "job", "job"], "en"), (["el", "puesto"], "es"), (["the", "le"], "fr"), (["the"], None)], "t array<string>, l string")
    assert [r[0] for r in df.select(L.remove_stopwords("t", "l")).collect()] == [["job", "job"], ["puesto"], ["the", "le"], ["the"]]


def test_detection(spark):
    texts = ["The work is for you and the team", "El trabajo es para ti y el equipo", "Wir sind nicht hier und ich auch", "xyz", None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    assert [r[0] for r in df.select(L.detect_language("t")).collect()] == ["en", "es", "de", None, None, None]


def test_normalise_detects_and_plugs_in(spark):
    df = spark.createDataFrame([("The companies and their skills: 3",), ("Las empresas y los trabajadores de la zona",)], "text string")
    assert [r["normalised"] for r in L.normalise_text(df).collect()] == ["company skill :", "empres trabaj zon"]
    upper = L.normalise_text(df, stemmers={"en": lambda: str.upper})
    assert upper.first()["normalised"] == "COMPANIES SKILLS :"


def plain_trigrams(text):
    import unicodedata

    letters = "".join(c if unicodedata.category(c)[0] == "L" and ord(c) < 0x10000 else " " for c in text.lower())
    spaced = f" {' '.join(letters.split())} "
    return [(ord(a) * 961 + ord(b) * 31 + ord(c)) % 4093 for a, b, c in zip(spaced, spaced[1:], spaced[2:])]


def test_trigrams_equal_plain_ones(spark):
    texts = ["The Work", "x", " a1b--Ñandú ", "日本語 текст", "\U0001d49c mixed \U0001f600", "", "12 !?", None, "ab " * 5000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    found = [r[0] for r in df.select(trigrams(F.col("t"))).collect()]
    assert found == [(plain_trigrams(t) or None) if t else None for t in texts]


def test_language_likelihoods(spark, plan):
    rows = [("the work for you and the team", "en"), ("el trabajo para ti y el equipo", "es"), ("und wir sind nicht hier", "de"), ("ignored", None), (None, "en"), ("...", "xx")]
    learned = learn_languages(spark.createDataFrame(rows, "text string, lang string"))
    assert list(learned.weights) == ["de", "en", "es"]  # a label without letters is not learned
    texts = ["and then the team", "trabajo y equipo", "wir sind nicht", None, "", "123"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    assert [r[1] for r in df.select("i", ngram_language("t", learned)).collect()] == ["en", "es", "de", None, None, None]
    text = plan(df.select(ngram_language("t", learned)))
    assert "EvalPython" not in text and "Join" not in text
    same = NgramLanguages({"aa": learned.weights["en"], "bb": learned.weights["en"]})
    assert df.select("i", ngram_language("t", same)).first()[1] == "aa"
    assert learn_languages(spark.createDataFrame([], "text string, lang string")).weights == {}
    assert df.select(ngram_language("t", NgramLanguages({}))).first()[0] is None
    with pytest.raises(ValueError):
        learn_languages(spark.createDataFrame(rows, "text string, lang string"), most_languages=1)


def test_trigrams_are_counted_without_a_row_for_each(spark, monkeypatch):
    from collections import Counter

    from postloom.functions import ngrams

    rows = [("ab cd " * 400, "en"), ("x", "en"), ("Ñandú 日本語 \U0001d49c", "es"), ("", "es"), (None, "es"), ("das ist", None), ("...", "de"), ("ab cd " * 400, "en")]
    texts = [t.lower() for t, code in rows if code == "en"]
    monkeypatch.setattr(ngrams, "PART", 7)  # windows that span two parts count too, those that span two texts do not
    counts = ngrams.count_trigrams([f" {t.strip()} " for t in texts])
    assert {b: n for b, n in enumerate(counts) if n} == Counter(b for t in texts for b in plain_trigrams(t))
    plans = []
    collect = type(spark.range(1)).collect

    def recorded(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return collect(df)

    monkeypatch.setattr(type(spark.range(1)), "collect", recorded)
    learned = learn_languages(spark.createDataFrame(rows, "text string, lang string").repartition(2))
    assert plans and not any("Generate" in text for text in plans)
    for code, weights in learned.weights.items():
        seen = Counter(b for t, c in rows if c == code and t for b in plain_trigrams(t))
        total = sum(seen.values()) + 4093
        assert weights == tuple(math.floor(1000 * math.log((seen[b] + 1) / total)) for b in range(4093))
    assert set(learned.weights) == {"en", "es"}


def test_language_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    learned = learn_languages(docs.filter(~fold))
    row = docs.filter(fold & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).agg(
        F.avg((ngram_language("text", learned) == F.col("lang")).cast("int")).alias("ngrams"), F.avg(F.coalesce(L.detect_language("text") == F.col("lang"), F.lit(False)).cast("int")).alias("words"), F.count("*").alias("n")).first()
    assert row["n"] > 100 and row["ngrams"] >= max(0.98, row["words"])


def test_normalise_takes_learned_languages(spark):
    learned = learn_languages(spark.createDataFrame([("the companies and their skills", "en"), ("las empresas y los trabajadores", "es")], "text string, lang string"))
    df = spark.createDataFrame([("companies skills",), ("empresas trabajadores",), (None,)], "text string")
    assert [r["normalised"] for r in L.normalise_text(df, languages=learned).collect()] == ["company skill", "empres trabaj", None]


LEMMAS = [("en", "mice", "mouse"), ("en", "mice", "mousey"), ("en", "went", "go"), ("en", "skills", "ability"), ("fr", "yeux", "oeil"), ("en", "nothing", None)]


@pytest.mark.parametrize("frequent", [0, 2, 50_000])
def test_lemma_dictionary(spark, frequent):
    rows = [
        (1, ["mice", "went", "mice", "boxes"], "en", "a"), (2, ["yeux", "mice"], "fr", "b"), (3, ["mice"], None, "c"), (4, [], "en", "d"),
        (5, None, "en", "e"), (None, ["mice"], "en", "f"), (None, ["went"], "en", "g"), (6, ["casas", None, "skills"], "es", "h"), (7, ["skills", "nothing", "x" * 100], "en", "i")]
    df = spark.createDataFrame(rows, "id int, tokens array<string>, lang string, lemma string")
    lemmas = spark.createDataFrame(LEMMAS, "lang string, word string, lemma string")
    found = lemmatise(df, lemmas, frequent=frequent)
    assert found.columns == df.columns
    assert {r["lemma"]: r["tokens"] for r in found.collect()} == {
        "a": ["mouse", "go", "mouse", "box"], "b": ["oeil", "mice"], "c": ["mice"], "d": [], "e": None, "f": ["mice"], "g": ["went"],
        "h": ["cas", None, "skills"], "i": ["ability", "nothing", "x" * 100]}


def test_lemmas_of_a_hot_word(spark):
    df = spark.range(2000).selectExpr("id", "'en' AS lang", "array('mice', 'w' || id, 'mice') AS tokens")
    lemmas = spark.createDataFrame(LEMMAS, "lang string, word string, lemma string")
    found = lemmatise(df, lemmas, frequent=1)
    assert found.filter("tokens = array('mouse', 'w' || id, 'mouse')").count() == 2000


def test_lemmas_compute_tokens_once_a_pass(spark, monkeypatch):
    from postloom.operators import lemmas as module

    plans = []
    kept = module.materialise

    def recorded(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return kept(df, name)

    monkeypatch.setattr(module, "materialise", recorded)
    df = spark.createDataFrame([(1, "mice went", "en")], "id int, text string, lang string").withColumn("tokens", F.split("text", "[ ]+"))
    found = lemmatise(df, spark.createDataFrame(LEMMAS, "lang string, word string, lemma string"))
    assert found.select("tokens").first()[0] == ["mouse", "go"]
    assert plans and not any("size(split(" in text for text in plans)  # no filter that splits the text again
