"""Text functions, token budgets and language-aware normalisation."""

from __future__ import annotations

import functools
from pathlib import Path

from pyspark.sql import functions as F

from catalog.registry import N_TOKENS_SQL, POSTING_TEXT_SQL, POSTINGS_SQL, postings, query, section_sql, table, truncated_sql
from postloom.functions import language as L
from postloom.functions.ngrams import learn_languages, ngram_language
from postloom.functions.text import clean_text, e5_prefix, join_sections, nest_sections, regex_normalise, section_format, word_count
from postloom.functions.tokens import token_count
from postloom.operators.filters import length_gate
from postloom.operators.lemmas import lemmatise
from postloom.operators.stats import budget_tokens
from postloom.operators.vocabulary import build_vocabulary, model_budget, model_token_counts, read_ranks
from postloom.session import materialise


@query("section_format", """
    SELECT doc_id AS id, '#### title: ' || coalesce(source, 'None') || ' ####' AS title,
        '#### location: ' || coalesce(lang, 'None') || ' ####' AS location,
        '#### description: ' || coalesce(text, 'None') || ' ####' AS description FROM documents""")
def _(spark, sf):
    return postings(spark, sf).select("id", *[section_format(c, c).alias(c) for c in ("title", "location", "description")])


@query("clean_text", "SELECT doc_id AS id, translate(text, '()'',', '') AS cleaned FROM documents")
def _(spark, sf):
    return postings(spark, sf).select("id", clean_text("description").alias("cleaned"))


@query("nest_sections", " UNION ALL ".join(
    f"SELECT id, {i}::INTEGER AS pos, {section_sql(c, c)} AS section FROM ({POSTINGS_SQL})"
    for i, c in enumerate(("title", "location", "description"))))
def _(spark, sf):
    return postings(spark, sf).select("id", F.posexplode(nest_sections()).alias("pos", "section"))


@query("join_sections", f"SELECT id, {POSTING_TEXT_SQL} AS text FROM ({POSTINGS_SQL})")
def _(spark, sf):
    return postings(spark, sf).select("id", join_sections(nest_sections()).alias("text"))


@query("e5_prefix", """
    SELECT doc_id AS id, 'query: ' || coalesce(text, 'None') AS as_query, 'passage: ' || coalesce(text, 'None') AS as_passage
    FROM documents""")
def _(spark, sf):
    return postings(spark, sf).select("id", e5_prefix("description").alias("as_query"), e5_prefix("description", "passage").alias("as_passage"))


@query("token_count", f"SELECT doc_id AS id, {N_TOKENS_SQL.format(text='text')}::INTEGER AS n_tokens FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents", ["doc_id", "text"]).select(F.col("doc_id").alias("id"), token_count("text").alias("n_tokens"))


@query("truncate_tokens", f"""
    SELECT doc_id AS id, {truncated_sql('text', 1000)} AS text, {N_TOKENS_SQL.format(text='text')}::INTEGER AS n_tokens,
        {N_TOKENS_SQL.format(text='text')} > 1000 AS truncated FROM documents""")
def _(spark, sf):
    return budget_tokens(table(spark, sf, "documents", ["doc_id", "text"]).select(F.col("doc_id").alias("id"), "text"))


@query("word_count", r"SELECT doc_id AS id, len(regexp_extract_all(text, '\S+'))::INTEGER AS words FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents", ["doc_id", "text"]).select(F.col("doc_id").alias("id"), word_count("text").alias("words"))


@query("length_gate", r"""
    SELECT id, words, CASE WHEN words > 50 THEN 'summarise' ELSE 'pass' END AS gate
    FROM (SELECT doc_id AS id, len(regexp_extract_all(text, '\S+'))::INTEGER AS words FROM documents)""")
def _(spark, sf):
    return length_gate(table(spark, sf, "documents", ["doc_id", "text"]).select(F.col("doc_id").alias("id"), "text")).select("id", "words", "gate")


# --- SQL twins of the language steps -----------------------------------------------------

_NORMALISED_SQL = r"""
    SELECT doc_id AS id, lang, text AS raw,
        lower(trim(regexp_replace(regexp_replace(text, '[^a-zA-Z\s:]+', ' ', 'g'), '\s+', ' ', 'g'))) AS clean
    FROM documents"""


# Fixed values of the twins, apart from the library's: list names by code, in order of priority.
_LISTS = {
    "en": "english", "es": "spanish", "fr": "french", "de": "german", "pt": "portuguese", "it": "italian", "nl": "dutch",
    "sv": "swedish", "da": "danish", "no": "norwegian", "fi": "finnish", "hu": "hungarian", "tr": "turkish", "ru": "russian",
}


@functools.cache
def _stop_list(code: str) -> list[str]:
    folder = Path(__file__).resolve().parent.parent / "postloom" / "stopwords"
    return [w for w in (folder / f"{_LISTS[code]}.txt").read_text(encoding="utf-8").split("\n") if w and w[0] != "#"]


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _tokens_sql(norm: str = _NORMALISED_SQL) -> str:
    """``toks (id, lang, pos, token)`` in long form."""
    spaced = r"regexp_replace(regexp_replace(clean, '([:,])([^\d])', ' \1 \2', 'g'), '([:,])$', ' \1 ', 'g')"
    for left, right in (("can", "not"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"), ("wan", "na")):
        spaced = rf"regexp_replace({spaced}, '\b({left})({right})\b', '\1 \2', 'g')"
    return f"""
    norm AS ({norm}),
    lists AS (SELECT id, lang, list_filter(string_split_regex({spaced}, ' +'), lambda t: t <> '') AS ts FROM norm),
    toks AS (SELECT id, lang, unnest(ts) AS token, generate_subscripts(ts, 1) AS pos FROM lists)"""


def _kept_sql() -> str:
    return f"""
    kept AS (SELECT * FROM toks WHERE NOT (coalesce(lang, '') = 'en' AND token IN ({_quoted(_stop_list('en'))}))
        AND NOT (coalesce(lang, '') = 'es' AND token IN ({_quoted(_stop_list('es'))})))"""


def _joined(relation: str, column: str, output: str) -> str:
    return f"""
    SELECT norm.id, coalesce(j.joined, '') AS {output} FROM norm LEFT JOIN (
        SELECT id, string_agg({column}, ' ' ORDER BY pos) AS joined FROM {relation} GROUP BY id) j ON j.id = norm.id"""


def _stems_sql() -> str:
    """``stemmed (id, pos, stem)``: the rules run once per distinct word."""
    return r"""
    vocab AS (SELECT DISTINCT lang, token FROM kept WHERE lang IN ('en', 'es')),
    words AS (SELECT lang, token, CASE
        WHEN lang = 'en' AND regexp_matches(token, '..ies$') THEN left(token, length(token) - 3) || 'y'
        WHEN lang = 'en' AND regexp_matches(token, '(ss|x|z|ch|sh)es$') THEN left(token, length(token) - 2)
        WHEN lang = 'en' AND regexp_matches(token, '.men$') THEN left(token, length(token) - 2) || 'an'
        WHEN lang = 'en' AND regexp_matches(token, '..[^sui]s$') THEN left(token, length(token) - 1)
        WHEN lang = 'es' AND regexp_matches(token, '...(amiento|imiento|acione|adore|adora|idade|ismo|ista|able|ible|logía)s$')
            THEN regexp_replace(token, '^(...+?)(amiento|imiento|acione|adore|adora|idade|ismo|ista|able|ible|logía)s$', '\1')
        WHEN lang = 'es' AND regexp_matches(token, '...(amiento|imiento|ación|adora|ador|idad|mente|ismo|ista|able|ible|logía)$')
            THEN regexp_replace(token, '^(...+?)(amiento|imiento|ación|adora|ador|idad|mente|ismo|ista|able|ible|logía)$', '\1')
        WHEN lang = 'es' AND regexp_matches(token, '...(iendo|ando|ieron|aron|aban|amos|emos|imos|(ad|id)[oa]s?|[aei]r)$')
            THEN regexp_replace(token, '^(...+?)(iendo|ando|ieron|aron|aban|amos|emos|imos|(ad|id)[oa]s?|[aei]r)$', '\1')
        WHEN lang = 'es' AND regexp_matches(token, '...[eoa]s$') THEN left(token, length(token) - 2)
        WHEN lang = 'es' AND regexp_matches(token, '...[aeoáéó]$') THEN left(token, length(token) - 1)
        ELSE token END AS stem FROM vocab),
    stemmed AS (
        SELECT kept.id, kept.pos, coalesce(words.stem, kept.token) AS stem
        FROM kept LEFT JOIN words ON words.lang = kept.lang AND words.token = kept.token)"""


def _detected_sql() -> str:
    counts = ", ".join(f"count(*) FILTER (word IN ({_quoted(_stop_list(code))})) AS n_{code}" for code in _LISTS)
    best = "greatest(" + ", ".join(f"n_{code}" for code in _LISTS) + ")"
    cases = " ".join(f"WHEN n_{code} = {best} THEN '{code}'" for code in _LISTS)
    return rf"""
    WITH words AS (SELECT doc_id AS id, unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS word FROM documents),
    votes AS (SELECT id, {counts} FROM words GROUP BY id)
    SELECT d.doc_id AS id, CASE WHEN {best} > 0 THEN CASE {cases} END END AS detected
    FROM documents d LEFT JOIN votes ON votes.id = d.doc_id"""


def _documents(spark, sf):
    return table(spark, sf, "documents", ["doc_id", "lang", "text"]).select(F.col("doc_id").alias("id"), "lang", "text")


def _clean_tokens(spark, sf):
    return _documents(spark, sf).select("id", "lang", L.tokenize(regex_normalise(F.col("text"))).alias("tokens"))


@query("regex_normalise", f"SELECT id, clean AS normalised FROM ({_NORMALISED_SQL})")
def _(spark, sf):
    return _documents(spark, sf).select("id", regex_normalise(F.col("text")).alias("normalised"))


@query("detect_language", _detected_sql)
def _(spark, sf):
    return _documents(spark, sf).select("id", L.detect_language("text").alias("detected"))


@query("tokenize", lambda: f"WITH {_tokens_sql()} {_joined('toks', 'token', 'tokens')}")
def _(spark, sf):
    return _clean_tokens(spark, sf).select("id", F.array_join("tokens", " ").alias("tokens"))


@query("remove_stopwords", lambda: f"WITH {_tokens_sql()}, {_kept_sql()} {_joined('kept', 'token', 'tokens')}")
def _(spark, sf):
    return _clean_tokens(spark, sf).select("id", F.array_join(L.remove_stopwords("tokens", "lang"), " ").alias("tokens"))


@query("stem_tokens", lambda: f"WITH {_tokens_sql()}, kept AS (SELECT * FROM toks), {_stems_sql()} {_joined('stemmed', 'stem', 'stems')}")
def _(spark, sf):
    return _clean_tokens(spark, sf).select("id", F.array_join(L.stem_tokens("tokens", "lang"), " ").alias("stems"))


@query("normalise_text", lambda: f"WITH {_tokens_sql()}, {_kept_sql()}, {_stems_sql()} {_joined('stemmed', 'stem', 'normalised')}")
def _(spark, sf):
    return L.normalise_text(_documents(spark, sf), "text", "lang").select("id", "normalised")


def _detected_norm_sql() -> str:
    return f"SELECT n.id, d.detected AS lang, n.clean FROM ({_NORMALISED_SQL}) n JOIN ({_detected_sql()}) d ON d.id = n.id"


@query("normalise_detected", lambda: f"WITH {_tokens_sql(_detected_norm_sql())}, {_kept_sql()}, {_stems_sql()} {_joined('stemmed', 'stem', 'normalised')}")
def _(spark, sf):
    return L.normalise_text(_documents(spark, sf), "text").select("id", "normalised")


# Trigrams of the basic plane's letters in 4,093 buckets; every count starts at one.
TRIGRAM_SQL = r"""
    WITH texts AS (SELECT doc_id AS id, lang, string_split(' ' || trim(regexp_replace(lower(text), '[\PL\x{10000}-\x{10FFFF}]+', ' ', 'g')) || ' ', '') AS cs FROM documents),
    codes AS (SELECT id, lang, unicode(unnest(cs))::BIGINT AS c, generate_subscripts(cs, 1) AS i FROM texts),
    grams AS (SELECT id, lang, c * 961 + lead(c) OVER w * 31 + lead(c, 2) OVER w AS code FROM codes WINDOW w AS (PARTITION BY id ORDER BY i)),
    placed AS (SELECT id, lang, code % 4093 AS bucket FROM grams WHERE code IS NOT NULL),
    counted AS (SELECT lang, bucket, count(*) AS n FROM placed WHERE lang IS NOT NULL GROUP BY ALL),
    totals AS (SELECT lang, sum(n) + 4093 AS total FROM counted GROUP BY lang),
    weights AS (
        SELECT t.lang, b.bucket, floor(1000 * ln((coalesce(n, 0) + 1) / total))::BIGINT AS weight
        FROM totals t CROSS JOIN (SELECT unnest(range(4093)) AS bucket) b LEFT JOIN counted c ON c.lang = t.lang AND c.bucket = b.bucket),
    scored AS (SELECT p.id, w.lang, sum(weight) AS score FROM placed p JOIN weights w USING (bucket) GROUP BY ALL),
    ranked AS (SELECT id, lang, row_number() OVER (PARTITION BY id ORDER BY score DESC, lang) AS place FROM scored)
    SELECT d.doc_id AS id, r.lang AS detected FROM documents d LEFT JOIN ranked r ON r.id = d.doc_id AND place = 1"""


@query("detect_language_ngrams", TRIGRAM_SQL)
def _(spark, sf):
    """The likeliest language of every document, learned from all rows that have one."""
    docs = _documents(spark, sf)
    return docs.select("id", ngram_language("text", learn_languages(docs)).alias("detected"))


# A dictionary from the texts themselves: a word with a last s belongs to the word without it
# where that one occurs in the same language too.
_LEMMAS_SQL = """
    attested AS (SELECT DISTINCT lang, token FROM toks WHERE lang IS NOT NULL),
    lemmas AS (SELECT a.lang, a.token, b.token AS lemma FROM attested a JOIN attested b ON b.lang = a.lang AND a.token = b.token || 's' WHERE length(b.token) >= 3),
    ruled AS (SELECT k.id, k.lang, k.token, k.pos, coalesce(words.stem, k.token) AS stem FROM kept k LEFT JOIN words ON words.lang = k.lang AND words.token = k.token),
    lemmatised AS (SELECT r.id, r.pos, coalesce(l.lemma, r.stem) AS lemma FROM ruled r LEFT JOIN lemmas l ON l.lang = r.lang AND l.token = r.token)"""


@query("lemma_dictionary", lambda: f"WITH {_tokens_sql()}, kept AS (SELECT * FROM toks), {_stems_sql()}, {_LEMMAS_SQL} {_joined('lemmatised', 'lemma', 'lemmas')}")
def _(spark, sf):
    # Written once: the words, the counts, the tokens in place and the result each read them.
    docs = materialise(_clean_tokens(spark, sf), "tokens")
    words = docs.filter("lang IS NOT NULL").select("lang", F.explode("tokens").alias("word")).distinct()
    plural = words.select("lang", F.col("word").alias("lemma")).filter("length(lemma) >= 3").withColumn("word", F.concat("lemma", F.lit("s")))
    return lemmatise(docs, plural.join(words, ["lang", "word"])).select("id", F.array_join("tokens", " ").alias("lemmas"))


# Where the public vocabularies are.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# The pattern's last but one alternative, white space that nothing follows, as a mark before
# the last blank of a run; then every different piece is merged pair by pair, lowest rank first.
# A character that the cut leaves incomplete is dropped.
MODEL_TOKENS_SQL = rf"""
    WITH RECURSIVE ranks AS (SELECT hex(from_base64(token)) AS h, rank FROM read_csv('{VOCABULARY}', delim = ' ', header = false, quote = '', escape = '', columns = {{'token': 'VARCHAR', 'rank': 'INTEGER'}})),
    docs AS (SELECT doc_id AS id, text, regexp_extract_all(regexp_replace(text, '(\s)(\s\S)', '\1' || chr(1) || '\2', 'g'),
        '''s|''t|''re|''ve|''m|''ll|''d| ?\pL+| ?\pN+| ?[^\s\pL\pN' || chr(1) || ']+|\s+') AS ps FROM documents),
    words AS (SELECT DISTINCT unnest(ps) AS piece FROM docs),
    merging AS (
        SELECT piece, regexp_extract_all(hex(encode(piece)), '..') AS parts FROM words
        UNION ALL
        SELECT piece, list_concat(list_concat(parts[:k - 1], [parts[k] || parts[k + 1]]), parts[k + 2:]) AS parts FROM (
            SELECT piece, parts, min(rank::BIGINT * 100000 + i) % 100000 AS k
            FROM (SELECT piece, parts, unnest(range(1, len(parts))) AS i FROM merging) JOIN ranks ON h = parts[i] || parts[i + 1]
            GROUP BY piece, parts)),
    encoded AS (SELECT piece, arg_min(parts, len(parts)) AS parts FROM merging GROUP BY piece),
    placed AS (SELECT id, ps[i] AS piece, i FROM (SELECT id, ps, unnest(range(1, len(ps) + 1)) AS i FROM docs)),
    counted AS (SELECT id, flatten(list(parts ORDER BY i)) AS parts FROM placed JOIN encoded USING (piece) GROUP BY id),
    cut AS (SELECT id, len(parts)::INTEGER AS n_tokens, len(parts) > 1000 AS truncated,
        length(regexp_replace(array_to_string(parts[:1000], ''), '([CDEF].|[EF].[89AB].|F.[89AB].[89AB].)$', '')) // 2 AS octets FROM counted)"""


def _model_vocabulary(spark, docs):
    return build_vocabulary(docs, read_ranks(spark, f"file:{VOCABULARY}"))


@query("model_token_count", f"{MODEL_TOKENS_SQL} SELECT d.id, coalesce(n_tokens, 0)::INTEGER AS n_tokens FROM docs d LEFT JOIN cut USING (id)")
def _(spark, sf):
    """Tokens of a model's vocabulary; every different piece of text is encoded once."""
    docs = table(spark, sf, "documents", ["doc_id", "text"]).select(F.col("doc_id").alias("id"), "text")
    counts = model_token_counts(docs, _model_vocabulary(spark, docs))
    return docs.select("id").join(counts, "id", "left").fillna(0, ["n_tokens"])


@query("model_budget", f"""{MODEL_TOKENS_SQL}
    SELECT d.id, coalesce(n_tokens, 0)::INTEGER AS n_tokens, coalesce(truncated, false) AS truncated,
        CASE WHEN truncated THEN octets ELSE strlen(text) END::INTEGER AS n_octets, sha256(CASE WHEN truncated THEN encode(text)[:octets] ELSE encode(text) END) AS text_sha256
    FROM docs d LEFT JOIN cut USING (id)""")
def _(spark, sf):
    """Texts cut to 1,000 tokens of a model's vocabulary."""
    docs = table(spark, sf, "documents", ["doc_id", "text"]).select(F.col("doc_id").alias("id"), "text")
    cut = model_budget(docs, _model_vocabulary(spark, docs), 1000)
    return cut.select("id", "n_tokens", "truncated", F.octet_length("text").alias("n_octets"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
