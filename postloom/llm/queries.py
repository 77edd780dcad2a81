"""The registered queries of this subpackage, each beside its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from postloom.llm import (
    collocations, decontamination, exact, fingerprints, importance, language_id, licences, minhash, mixing, secrets, sharding, token_shards, warc,
)
from postloom.session import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op1_sharding")
def op1_sharding(spark, sf_dir):
    """All documents over 24 equal shards, and where one more shard would put them."""
    return sharding.shard_records(documents(spark, sf_dir), weights=[1.0] * 24, grown_weight=1.0).withColumn("law", F.lit("key"))


@query("op2_licences")
def op2_licences(spark, sf_dir):
    """Licence phrases and template spans of all documents."""
    found = licences.scan_licences(documents(spark, sf_dir))
    starts, own = F.col("phrases.start"), F.col("phrases.label")
    covers = F.transform("spans", lambda s: s["cover"])
    # A phrase is a template that is covered whole.
    score = F.when(F.size("phrases") > 0, 1.0).when(F.size("spans") > 0, F.least(F.array_max(covers), F.lit(1.0))).otherwise(0.0)
    return found.select(
        "doc_id", "n_words", F.size("phrases").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(own)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(own, F.col("spans.label"))), ",").alias("labels"),
        score.alias("score"), F.size("spans").cast("long").alias("n_spans"),
    )


# Where the public vocabularies are.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def training_order(docs: DataFrame) -> DataFrame:
    """The sequences of all documents, written in training order and read back from the shards."""
    spark = docs.sparkSession
    path = fresh_path(spark, "token-shards")
    token_shards.write_training_order(docs, path, token_shards.read_ranks(VOCABULARY))
    return token_shards.read_training_order(spark, path).select(
        "slot", "shard", F.col("key").alias("doc_id"), "seq", "n_tokens", F.crc32("tokens").alias("tokens_crc32"))


@query("op3_token_shards")
def op3_token_shards(spark, sf_dir):
    """All documents as token sequences of 256 in training order."""
    return training_order(documents(spark, sf_dir))


@query("op4_secrets")
def op4_secrets(spark, sf_dir):
    """Secrets of all documents, as counts and positions."""
    found = secrets.scan_secrets(documents(spark, sf_dir))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(*kinds):
        return F.filter("secrets", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id", *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in secrets.BASE_KINDS],
        F.sha2(joined(of(*secrets.BASE_KINDS)).cast("binary"), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"),
    )


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NEAR_DUPLICATES_SQL = rf"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY ALL),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT doc_id, doc_id AS node FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(node) AS component_id FROM reach GROUP BY ALL) r USING (doc_id)"""


@query("op5_minhash", NEAR_DUPLICATES_SQL)
def op5_minhash(spark, sf_dir):
    """Near-duplicate classes of all documents at similarity 0.85."""
    return minhash.near_duplicates(documents(spark, sf_dir), percent=85)


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS h, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
    translate(array_to_string(list_transform(range(8), lambda i: to_base(('0x' || substr(h, (i * 5 + 1)::BIGINT, 5))::BIGINT, 32, 4)), ''),
        '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM d"""


@query("op6_warc", WARC_SQL)
def op6_warc(spark, sf_dir):
    """All pages into a new archive, whose records are then read back."""
    path = fresh_path(spark, "warc")
    warc.write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return warc.read_records(spark, path).select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_decontamination")
def op7_decontamination(spark, sf_dir):
    """Benchmark items that documents hold, verbatim or with other numbers, names and units."""
    return decontamination.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("op8_fingerprints")
def op8_fingerprints(spark, sf_dir):
    """Fingerprints of all documents, compared with their edited texts and successors."""
    return fingerprints.compare_versions(documents(spark, sf_dir))


@query("op9_language_id")
def op9_language_id(spark, sf_dir):
    """Languages of all documents, learned from the folds that are not held out."""
    docs = documents(spark, sf_dir)
    found = language_id.predict_languages(docs, language_id.fit_languages(docs))
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


# Shares of the tokens after mixing; the leading domain is used a little more than once.
MIXTURE, EPOCHS = {"good": 0.9, "poor": 0.1, "toxic": 0.0}, 1.05


@query("op10_mixing")
def op10_mixing(spark, sf_dir):
    """Posteriors and rates of all documents for the shares of MIXTURE."""
    rates, mixture = mixing.mix(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), MIXTURE, EPOCHS)
    posteriors = [F.get("p", d).alias(f"p_{name}") for d, name in enumerate(mixture.model.domains)]
    return rates.select(F.col("key").alias("doc_id"), "n_tokens", *posteriors, "rate", mixing.drawn_copies(F.col("rate"), F.col("key")).alias("copies"))


FOLDED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
WORDS_SQL = rf"regexp_extract_all({FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _ngrams_sql(words: str) -> str:
    return f"list_concat({words}, list_transform(range(1, len({words})), lambda i: array_to_string({words}[i:i + 1], ' ')), list_transform(range(1, len({words}) - 1), lambda i: array_to_string({words}[i:i + 2], ' ')))"


# The checksum of each different n-gram, one octet after the other by the usual table.
IMPORTANCE_SQL = rf"""
WITH RECURSIVE crc_rows AS (SELECT i, i::BIGINT AS c, 0 AS k FROM range(256) r(i)
    UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM crc_rows WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS tab FROM crc_rows WHERE k = 8),
d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
dg AS (SELECT doc_id, len(w) AS n_words, {_ngrams_sql('w')} AS g FROM d),
bw AS (SELECT {WORDS_SQL} AS w FROM benchmark),
df AS (SELECT doc_id, unnest(g) AS g FROM dg),
bf AS (SELECT unnest({_ngrams_sql('w')}) AS g FROM bw),
octets AS (SELECT g, list_transform(regexp_extract_all(hex(encode(g)), '..'), lambda x: ('0x' || x)::BIGINT) AS o FROM (SELECT g FROM df UNION SELECT g FROM bf)),
hashed AS (SELECT g, xor(list_reduce(list_prepend(4294967295::BIGINT, o), lambda acc, b: xor(acc // 256, tab[xor(acc, b) % 256 + 1])), 4294967295) % 10000 AS bucket
    FROM octets, crc),
s AS (SELECT bucket, count(*) AS s FROM df JOIN hashed USING (g) GROUP BY ALL),
t AS (SELECT bucket, count(*) AS t FROM bf JOIN hashed USING (g) GROUP BY ALL),
totals AS (SELECT (SELECT count(*) FROM df)::DOUBLE AS big_s, (SELECT count(*) FROM bf)::DOUBLE AS big_t),
gains AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (big_s + 10000) / ((coalesce(s, 0) + 1.0::DOUBLE) * (big_t + 10000))))::BIGINT AS gain
    FROM s FULL JOIN t USING (bucket), totals),
weights AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM df JOIN hashed USING (g) JOIN gains USING (bucket) GROUP BY ALL),
scored AS (SELECT doc_id, n_words, len(g)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
        (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
    FROM dg LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT doc_id, n_words::BIGINT AS n_words, n_features, weight, score, CASE WHEN rank <= 5 * n // 100 THEN rank END::BIGINT AS rank FROM scored LEFT JOIN ranked USING (doc_id)"""


@query("op11_importance", IMPORTANCE_SQL)
def op11_importance(spark, sf_dir):
    """Weights, scores and draws of all documents towards the benchmark's n-grams."""
    return importance.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


EXACT_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""


@query("op12_exact", EXACT_SQL)
def op12_exact(spark, sf_dir):
    """Groups of equal texts of all documents."""
    return exact.exact_duplicates(documents(spark, sf_dir), all_digests=True).withColumnRenamed("keep", "keep_id")


COLLOCATIONS_SQL = rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({FOLDED}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (SELECT lang, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: array_to_string(w[i:i + 1], ' ')),
    list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')))) AS phrase FROM w),
f AS (SELECT lang, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE phrase NOT LIKE '% %' GROUP BY ALL),
c AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE phrase LIKE '% %' AND f >= 10),
k AS (SELECT *, unnest(range(1, len(ws))) AS k FROM c),
cut AS (SELECT k.lang, k.phrase, k.a, k.k, l.f AS l, r.f AS r, 1000000::HUGEINT * k.a * k.a // (l.f * r.f) AS score FROM k
    JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(k.ws[1:k.k], ' ')
    JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(k.ws[k.k + 1:], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (SELECT lang, part, max(a) AS a FROM (SELECT lang, a, unnest([ws[1] || ' ' || ws[2], ws[2] || ' ' || ws[3]]) AS part FROM c WHERE len(ws) = 3) GROUP BY ALL),
free AS (SELECT b.* FROM best b LEFT JOIN held h ON h.lang = b.lang AND h.part = b.phrase WHERE h.a IS NULL OR 100 * h.a < 50 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM free)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""


@query("op13_collocations", COLLOCATIONS_SQL)
def op13_collocations(spark, sf_dir):
    """The phrases of each language whose words keep together most."""
    return collocations.collocations(documents(spark, sf_dir))
