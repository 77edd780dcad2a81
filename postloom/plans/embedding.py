"""Embedding runs: the incremental run behind a watermark, and the remote-encoder run."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from postloom import hooks
from postloom.functions.text import posting_text
from postloom.operators.embedding import API_CHUNK, assemble_embeddings, embed_column
from postloom.operators.merge import insert_into
from postloom.operators.stats import MAX_TOKENS, batch_stats, budget_tokens
from postloom.sources.collection import collection_add
from postloom.schemas import POSTING_COLUMNS
from postloom.sources.postings import incremental_scan, watermark_advance
from postloom.sources.tables import csv_sink, ensure_table, parquet_sink, run_report_append, table_exists
from postloom.sources.watermark import commit_watermark, read_watermark


@dataclass(frozen=True)
class InsertReport:
    initial_count: int
    jobs_added: int
    final_count: int
    seconds: float
    max_id: int


def budgeted_postings(postings: DataFrame, max_tokens: int = MAX_TOKENS, tokenizer: hooks.TokenizerFactory | None = None) -> DataFrame:
    """``(id, timestamp, text, n_tokens, truncated)``: sections formatted, joined and cut."""
    return budget_tokens(postings.select("id", "timestamp", posting_text().alias("text")), max_tokens, "text", tokenizer)


def _stored_rows(spark: SparkSession, table_path: str) -> int:
    return spark.read.parquet(table_path).count() if table_exists(spark, table_path) else 0


def embedding_run(
    spark: SparkSession,
    source: DataFrame,
    table_path: str,
    watermark_path: str,
    *,
    order_by,
    max_tokens: int = MAX_TOKENS,
    kind: str = "query",
    dim: int = 64,
    encoder: hooks.EncoderFactory | None = None,
    tokenizer: hooks.TokenizerFactory | None = None,
    report_path: str | None = None,
) -> InsertReport:
    """Embed the postings above the watermark, insert them, then commit the new mark.

    Of several postings with one id the first by ``order_by`` is stored.

    Keys that the table holds already are dropped first, so the encoder sees only rows that
    will be stored, and each of them once. The mark moves only after the insert: a run that
    dies in between repeats its rows, and the insert ignores those already stored. Without
    new rows nothing is written. The report covers all rows above the mark.
    """
    started = time.monotonic()
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    columns = list(dict.fromkeys([*POSTING_COLUMNS, *order]))
    mark = read_watermark(spark, watermark_path)
    upper = watermark_advance(incremental_scan(source, mark), mark).first()["max_id"]
    if upper == mark:
        stored = _stored_rows(spark, table_path)
        return InsertReport(stored, 0, stored, time.monotonic() - started, mark)
    rows = incremental_scan(source, mark, upper, columns)
    if report_path:
        stats = batch_stats(budgeted_postings(rows, max_tokens, tokenizer))
        run_report_append(stats.withColumn("ts", F.current_timestamp()), report_path)

    def embed(fresh: DataFrame) -> DataFrame:
        return assemble_embeddings(budgeted_postings(fresh, max_tokens, tokenizer), encoder, kind, dim)

    ensure_table(spark, table_path, embed(rows).schema)
    initial = _stored_rows(spark, table_path)
    added = insert_into(table_path, rows, order_by=order_by, enrich=embed)
    commit_watermark(spark, watermark_path, upper)
    return InsertReport(initial, added, initial + added, time.monotonic() - started, upper)


def api_embedding_run(
    postings: DataFrame,
    path: str,
    sink: str = "parquet",
    *,
    order_by=None,
    encoder: hooks.EncoderFactory | None = None,
    max_tokens: int = MAX_TOKENS,
    dim: int = 64,
    tokenizer: hooks.TokenizerFactory | None = None,
) -> None:
    """Embed the unprefixed texts and store them; the watermark does not move.

    ``sink`` is ``parquet`` (with the timestamp), ``csv`` (without it) or ``collection``,
    which adds the first row of each new id by ``order_by``.
    """
    if sink not in ("parquet", "csv", "collection"):
        raise ValueError(f"unknown sink {sink!r}")
    if sink == "collection" and order_by is None:
        raise ValueError("name the columns that order the rows of an id")

    def embed(rows: DataFrame) -> DataFrame:
        texts = budgeted_postings(rows, max_tokens, tokenizer).select("id", F.col("text").alias("original"), "timestamp")
        return embed_column(texts, "original", "embedding", encoder, dim, API_CHUNK)

    if sink == "parquet":
        parquet_sink(embed(postings).select("id", "original", "embedding", "timestamp"), path)
    elif sink == "csv":
        csv_sink(embed(postings), path, ("id", "original", "embedding"))
    else:
        collection_add(postings, path, order_by=order_by, enrich=lambda rows: embed(rows).withColumnRenamed("original", "document"))
