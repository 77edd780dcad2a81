"""Language-aware normalisation: detect, tokenise, drop stop words, stem.

Without further input, detection is a vote of stop words, and English lemmas and Spanish
stems follow short lists of suffix rules, all column expressions. ``postloom.functions.ngrams``
learns languages from labelled rows, ``postloom.operators.lemmas`` takes a dictionary, and
own models plug in through ``postloom.hooks``.
"""

from __future__ import annotations

import functools
from pathlib import Path

from pyspark.sql import Column, DataFrame, functions as F

from postloom import hooks
from postloom.functions.ngrams import NgramLanguages, ngram_language
from postloom.functions.text import regex_normalise

# Language code -> name of a stop-word list beside this package. The order decides ties.
STOP_LISTS = {
    "en": "english", "es": "spanish", "fr": "french", "de": "german", "pt": "portuguese", "it": "italian", "nl": "dutch",
    "sv": "swedish", "da": "danish", "no": "norwegian", "fi": "finnish", "hu": "hungarian", "tr": "turkish", "ru": "russian",
}
NORMALISED_LANGUAGES = ("en", "es")

# How the word tokenizer splits colons and glued English forms.
COLON_INSIDE = r"([:,])([^\d])"
COLON_AT_END = r"([:,])$"
GLUED_FORMS = r"\b(can(?=not\b)|(?:gim|lem)(?=me\b)|(?:gon|wan)(?=na\b)|got(?=ta\b))"


@functools.cache
def stop_words(language: str) -> list[str]:
    """Stop words of a language code, from the lists in the package; read on the driver."""
    lines = (Path(__file__).resolve().parent.parent / "stopwords" / f"{STOP_LISTS[language]}.txt").read_text(encoding="utf-8").split("\n")
    return [word for word in lines if word and not word.startswith("#")]


def _col(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _listed(words) -> str:
    """A SQL list. As text it reaches the JVM at once; thousands of literals made one by one
    from Python would take seconds. Spark turns the comparison into a hash lookup."""
    return "(" + ", ".join("'" + w.replace("'", "\\'") + "'" for w in words) + ")"


def detect_language(column: str, languages=tuple(STOP_LISTS)) -> Column:
    """The language whose stop words occur most often in the named column; NULL if none does."""
    lists = {code: stop_words(code) for code in languages}
    # Most words are in no list; dropping them first leaves little to look up per language.
    # Wrapping a value in an array names it, so that it is computed once.
    words = f"regexp_extract_all(lower(`{column}`), r'\\p{{L}}+', 0)"
    telling = f"filter({words}, w -> w IN {_listed(sorted(set().union(*lists.values())))})"
    votes = ", ".join(
        f"struct(size(filter(ws, w -> w IN {_listed(stops)})) AS n, {-position} AS priority, '{code}' AS lang)"
        for position, (code, stops) in enumerate(lists.items())
    )
    best = F.expr(f"transform(array({telling}), ws -> array_max(array({votes})))")
    return F.transform(best, lambda b: F.when(b["n"] > 0, b["lang"]))[0]


def tokenize(col) -> Column:
    """Tokens of normalised text; colons become tokens and glued forms come apart."""
    spaced = F.regexp_replace(_col(col), COLON_INSIDE, " $1 $2")
    spaced = F.regexp_replace(spaced, COLON_AT_END, " $1 ")
    spaced = F.regexp_replace(spaced, GLUED_FORMS, "$1 ")
    return F.filter(F.split(spaced, " +"), lambda t: t != "")


def remove_stopwords(tokens: str, lang: str, languages=NORMALISED_LANGUAGES) -> Column:
    """Drop the stop words of the row's language from the named token column; other
    languages keep every token."""
    kept = None
    for code in languages:
        without = F.expr(f"filter(`{tokens}`, t -> t NOT IN {_listed(stop_words(code))})")
        kept = F.when(F.col(lang) == code, without) if kept is None else kept.when(F.col(lang) == code, without)
    return kept.otherwise(F.col(tokens))


# --- Suffix rules: pattern, replacement; the first that matches applies -------------------

ENGLISH_RULES = (
    (r"(?<=.{2})ies$", "y"),
    (r"(?<=ss|x|z|ch|sh)es$", ""),
    (r"(?<=.)men$", "man"),
    (r"(?<=..[^sui])s$", ""),
)
SPANISH_RULES = (
    (r"(?<=.{3})(?:amientos?|imientos?|aciones|ación|adores|adoras?|ador|idades|idad|mente|ismos?|istas?|ables?|ibles?|logías?)$", ""),
    (r"(?<=.{3})(?:iendo|ando|ieron|aron|aban|ados?|adas?|idos?|idas?|amos|emos|imos|ar|er|ir)$", ""),
    (r"(?<=.{3})(?:es|os|as|[aeoáéó])$", ""),
)
SUFFIX_RULES = {"en": ENGLISH_RULES, "es": SPANISH_RULES}


def strip_suffixes(tokens: Column, rules) -> Column:
    """Every token after the first rule that matches it."""
    def strip(word: Column) -> Column:
        stem = None
        for pattern, replacement in rules:
            matches, changed = word.rlike(pattern), F.regexp_replace(word, pattern, replacement)
            stem = F.when(matches, changed) if stem is None else stem.when(matches, changed)
        return stem.otherwise(word)

    return F.transform(tokens, strip)


def stem_tokens(tokens, lang, stemmers: dict[str, hooks.StemmerFactory] | None = None) -> Column:
    """Lemmas for ``en``, stems for ``es``, other languages unchanged.

    A stemmer hook for a language code replaces or adds to these. All hooks are one Python
    function, which sees the tokens of their languages only: the others reach it as NULL,
    because a conditional alone does not keep a Python function from running.
    """
    tokens, lang = _col(tokens), _col(lang)
    columns = {code: strip_suffixes(tokens, rules) for code, rules in SUFFIX_RULES.items() if code not in (stemmers or {})}
    stemmed = None
    if stemmers:
        hooked = lang.isin(*stemmers)
        stemmed = F.when(hooked, hooks.stem_udf(dict(stemmers))(lang, F.when(hooked, tokens)))
    for code, column in columns.items():
        stemmed = F.when(lang == code, column) if stemmed is None else stemmed.when(lang == code, column)
    return stemmed.otherwise(tokens)


def normalise_text(df: DataFrame, text_col: str = "text", lang_col: str | None = None, output_col: str = "normalised", stemmers=None,
                   languages: NgramLanguages | None = None) -> DataFrame:
    """Add the normalised text: detect, clean, tokenise, drop stop words, stem, join.

    ``lang_col`` names a column that already holds the language of the raw text. Without it
    ``languages``, a learned table of trigrams, decides, and without that the stop words.
    """
    detected = ngram_language(text_col, languages) if languages else detect_language(text_col)
    known = df.withColumn("_lang", F.col(lang_col) if lang_col else detected)
    tokens = known.withColumn("_tokens", tokenize(regex_normalise(F.col(text_col))))
    kept = tokens.withColumn("_tokens", remove_stopwords("_tokens", "_lang"))
    stemmed = kept.withColumn(output_col, F.array_join(stem_tokens("_tokens", "_lang", stemmers), " "))
    return stemmed.drop("_lang", "_tokens")
