"""Registry of the checked queries: a Spark callable and, where possible, its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from postloom.sources.tables import parquet_scan

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str | Callable[[], str]] = {}


def query(name: str, sql: str | Callable[[], str] | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    """A whole table."""
    return parquet_scan(spark, f"{sf_dir}/{name}.parquet", columns)


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table in the shape of the postings table."""
    return table(spark, sf_dir, "documents", ("doc_id", "source", "text", "lang")).select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("title"),
        F.col("text").alias("description"),
        F.col("lang").alias("location"),
        F.expr("timestampadd(MINUTE, cast(doc_id AS INT), TIMESTAMP_NTZ '2024-01-01 00:00:00')").alias("timestamp"),
    )


POSTINGS_SQL = """SELECT doc_id AS id, source AS title, text AS description, lang AS location,
    TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id) AS timestamp FROM documents"""


def section_sql(label: str, column: str) -> str:
    return f"translate('#### {label}: ' || coalesce({column}, 'None') || ' ####', '()'',', '')"


POSTING_TEXT_SQL = " || ' ' || ".join(
    section_sql(label, label) for label in ("title", "location", "description")
)

# Built-in tokens in DuckDB: count, and the prefix of at most k tokens.
N_TOKENS_SQL = r"len(regexp_extract_all({text}, '\S+'))"


def truncated_sql(text: str, k: int) -> str:
    return (
        rf"CASE WHEN len(regexp_extract_all({text}, '\S+')) <= {k} THEN {text} "
        rf"ELSE array_to_string(list_slice(regexp_extract_all({text}, '\s*\S+'), 1, {k}), '') END"
    )


def hashed_sql(source: str, key: str, text: str, dim: int = 64, suffix: str = "") -> str:
    """CTEs that give ``hashed (key, pos, value)``, the hashing encoder in long form."""
    x = suffix
    return rf"""
    src{x} AS ({source}),
    words{x} AS (SELECT {key}, unnest(regexp_extract_all({text}, '\S+')) AS word FROM src{x}),
    buckets{x} AS (
        SELECT {key}, (concat('0x', substr(md5(word), 1, 8))::UBIGINT % {dim})::INTEGER AS pos, count(*)::DOUBLE AS c
        FROM words{x} GROUP BY ALL),
    lengths{x} AS (SELECT {key}, sqrt(sum(c * c)) AS length FROM buckets{x} GROUP BY ALL),
    slots{x} AS (SELECT s.{key}, p.pos FROM src{x} s, (SELECT unnest(range({dim}))::INTEGER AS pos) p),
    hashed{x} AS (
        SELECT s.{key}, s.pos, coalesce(b.c / l.length, 0.0)::FLOAT::DOUBLE AS value
        FROM slots{x} s LEFT JOIN buckets{x} b ON b.{key} = s.{key} AND b.pos = s.pos
        LEFT JOIN lengths{x} l ON l.{key} = s.{key})"""


def embedded_sql(relation: str, text: str, prefix: str = "query: ") -> str:
    """The rest of a WITH clause: every vector element of the embedded rows of ``relation (id, text, timestamp)``."""
    cut = truncated_sql("full_text", 512)
    return f"""{hashed_sql(f"SELECT id, {cut} AS text FROM (SELECT id, '{prefix}' || {text} AS full_text FROM {relation})", 'id', 'text')}
    SELECT b.id, md5(b.{text}) AS {text}_md5, b.timestamp, h.pos, round(h.value, 6)::DOUBLE AS value
    FROM {relation} b JOIN hashed h ON h.id = b.id"""


def embedded_rows(rows: DataFrame, text: str) -> DataFrame:
    """The same from a table of embeddings; texts as digests, since they repeat per element."""
    elements = rows.select("id", F.md5(text).alias(f"{text}_md5"), "timestamp", F.posexplode("embedding").alias("pos", "value"))
    return elements.withColumn("value", F.round(F.col("value").cast("double"), 6))
