"""Lemmas from a dictionary table, joined to the different words; suffix rules for words that it lacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from postloom.functions.language import SUFFIX_RULES, strip_suffixes
from postloom.session import materialise

# The most frequent words, which go to all tasks; they are also those that would be hot keys.
FREQUENT_WORDS = 50_000
# Longer words are never among them, which bounds the octets that are broadcast.
FREQUENT_LENGTH = 64


def rule_lemma(word: Column, lang: Column) -> Column:
    """A word after the suffix rules of its language; the word itself where there are none."""
    lemma = None
    for code, rules in SUFFIX_RULES.items():
        stripped = strip_suffixes(F.array(word), rules)[0]
        lemma = F.when(lang == code, stripped) if lemma is None else lemma.when(lang == code, stripped)
    return lemma.otherwise(word)


def lemma_vocabulary(words: DataFrame, lemmas: DataFrame) -> DataFrame:
    """``(lang, word, n, lemma)`` of the different ``words (lang, word)``, written to the shared folder.

    ``lemmas (lang, word, lemma)`` is the dictionary; of several lemmas of a word the
    smallest counts, null ones do not. Counts are merged before the shuffle.
    """
    different = words.filter("word IS NOT NULL").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    known = lemmas.filter("lemma IS NOT NULL").groupBy("lang", "word").agg(F.min("lemma").alias("known"))
    lemma = F.coalesce("known", rule_lemma(F.col("word"), F.col("lang")))
    return materialise(different.join(known, ["lang", "word"], "left").select("lang", "word", "n", lemma.alias("lemma")), "lemma-vocabulary")


def lemmatise(df: DataFrame, lemmas: DataFrame, key: str = "id", tokens: str = "tokens", lang: str = "lang", frequent: int = FREQUENT_WORDS) -> DataFrame:
    """``df`` with its token column replaced by lemmas.

    Every different word is looked up once. The ``frequent`` most frequent words meet their
    lemma where the token is read; the others, none of them hot, are joined by word. Keys
    are unique; rows without key, with null or with no tokens stay as they are, and so do
    null tokens. The language ``NULL`` has neither dictionary nor rules.
    """
    # Not the inner form: for that the optimizer adds a filter that computes all tokens a second time.
    placed = df.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.posexplode_outer(F.col(tokens)).alias("pos", "word")).filter("pos IS NOT NULL")
    table = lemma_vocabulary(placed, lemmas)
    short = table.filter(F.length("word") <= FREQUENT_LENGTH).orderBy(F.desc("n"), "lang", "word").limit(frequent)
    top = materialise(short.select("lang", "word", "lemma"), "frequent-lemmas")
    met = materialise(placed.join(F.broadcast(top), ["lang", "word"], "left"), "lemma-tokens")
    open_ = "lemma IS NULL AND word IS NOT NULL"
    rest = met.filter(open_).drop("lemma").join(table.drop("n"), ["lang", "word"])
    whole = met.filter(f"NOT ({open_})").unionByName(rest)
    rebuilt = whole.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("pos", "lemma"))).alias("_placed"))
    found = rebuilt.select(F.col("key").alias(key), F.transform("_placed", lambda t: t["lemma"]).alias("_lemmas"))
    joined = df.join(found, key, "left")
    return joined.select(*[F.coalesce("_lemmas", F.col(tokens)).alias(c) if c == tokens else F.col(c) for c in df.columns])
