"""Scans, sinks, watermarks and keyed merges."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from catalog.registry import N_TOKENS_SQL, POSTING_TEXT_SQL, POSTINGS_SQL, embedded_rows, embedded_sql, hashed_sql, postings, query, table, truncated_sql
from postloom.operators.embedding import embed_column
from postloom.operators.keyed import create_keyed_table, read_keyed_table, update_table
from postloom.operators.merge import append_keep_last, insert_ignore, insert_into, insert_report
from postloom.operators.stats import batch_stats, budget_tokens
from postloom.plans.embedding import api_embedding_run, budgeted_postings, embedding_run
from postloom.session import fresh_path, materialise
from postloom.sources.collection import collection_add, collection_count, collection_get, collection_peek
from postloom.sources.postings import incremental_scan, watermark_advance
from postloom.sources.processed import commit_processed, read_processed, unprocessed
from postloom.sources.tables import append_tables, csv_scan, csv_sink, ensure_table, parquet_scan, parquet_sink, rename_legacy_key, run_report_append, run_report_scan, with_file_order
from postloom.sources.watermark import commit_watermark, read_watermark
from postloom.streaming.increments import embedding_stream, posting_stream, state_insert_stream
from postloom.streaming.marks import marked_stream


@query("parquet_scan", "SELECT doc_id, lang, source, n_chars FROM documents")
def _(spark, sf):
    return parquet_scan(spark, f"{sf}/documents.parquet", ["doc_id", "lang", "source", "n_chars"])


@query("incremental_scan", f"SELECT id, title, description, location, timestamp FROM ({POSTINGS_SQL}) WHERE id > 0")
def _(spark, sf):
    return incremental_scan(postings(spark, sf), max_id=0)


@query("watermark_advance", f"SELECT coalesce(max(id), 0)::BIGINT AS max_id FROM ({POSTINGS_SQL}) WHERE id > 0")
def _(spark, sf):
    return watermark_advance(incremental_scan(postings(spark, sf), max_id=0), 0)


@query("watermark_commit", """
    SELECT 1::INTEGER AS run, 0::BIGINT AS mark_before, count(*) AS rows_read, max(doc_id) AS mark_after
    FROM documents WHERE doc_id > 0
    UNION ALL SELECT 2, max(doc_id), 0, max(doc_id) FROM documents""")
def _(spark, sf):
    path, runs = fresh_path(spark, "watermark"), []
    for run in (1, 2):
        mark = read_watermark(spark, path)
        rows = incremental_scan(postings(spark, sf), mark, columns=("id",))
        found = rows.agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top")).first()
        if found["n"]:
            commit_watermark(spark, path, found["top"])
        runs.append((run, mark, found["n"], read_watermark(spark, path)))
    return spark.createDataFrame(runs, "run int, mark_before long, rows_read long, mark_after long")


@query("parquet_sink", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def _(spark, sf):
    path = fresh_path(spark, "documents")
    parquet_sink(table(spark, sf, "documents"), path)
    return parquet_scan(spark, path)


@query("csv_sink", "SELECT doc_id AS id, text AS original, source AS summary FROM documents")
def _(spark, sf):
    path = fresh_path(spark, "summaries-csv")
    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("original"), F.col("source").alias("summary"))
    csv_sink(rows, path)
    return csv_scan(spark, path, "id long, original string, summary string")


@query("csv_embeddings", """
    SELECT vec_id AS id, label::VARCHAR AS original, (p - 1)::INTEGER AS pos, embedding[p]::DOUBLE AS value
    FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS p FROM embeddings)""")
def _(spark, sf):
    path = fresh_path(spark, "embeddings-csv")
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").cast("string").alias("original"), "embedding")
    csv_sink(rows, path, ("id", "original", "embedding"))
    stored = csv_scan(spark, path, "id long, original string, embedding string")
    vector = F.from_json("embedding", "array<float>")
    return stored.select("id", "original", F.posexplode(vector).alias("pos", "value")).withColumn("value", F.col("value").cast("double"))


def _documents_and_turns(spark, sf):
    first = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    second = table(spark, sf, "conversations").select(F.col("conv_id").alias("id"), "text")
    return first, second


@query("append_tables", """
    SELECT doc_id AS id, text, 0::INTEGER AS src FROM documents
    UNION ALL SELECT conv_id, text, 1 FROM conversations""")
def _(spark, sf):
    return append_tables(*_documents_and_turns(spark, sf), source_column="src")


def _stored_and_new(spark, sf):
    stored = table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), F.lit(-1).cast("long").alias("seq"), "text")
    new = table(spark, sf, "conversations").select(F.col("conv_id").alias("id"), F.col("turn").alias("seq"), "text")
    return stored, new


_ADDED_SQL = """
    SELECT conv_id AS id, turn AS seq, text FROM (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place FROM conversations)
    WHERE place = 1 AND conv_id NOT IN (SELECT item_id FROM benchmark)"""


@query("insert_ignore", f"SELECT item_id AS id, (-1)::BIGINT AS seq, text FROM benchmark UNION ALL {_ADDED_SQL}")
def _(spark, sf):
    return insert_ignore(*_stored_and_new(spark, sf), order_by="seq")


@query("insert_report", f"""
    SELECT initial_count, jobs_added, initial_count + jobs_added AS final_count FROM (
        SELECT (SELECT count(*) FROM benchmark) AS initial_count, (SELECT count(*) FROM ({_ADDED_SQL})) AS jobs_added)""")
def _(spark, sf):
    return insert_report(*_stored_and_new(spark, sf))


_KEPT_SQL = """
    SELECT id, seq, text FROM (
        SELECT *, row_number() OVER (PARTITION BY id ORDER BY src DESC, seq DESC) AS place FROM (
            SELECT doc_id AS id, 0::BIGINT AS seq, text, 0 AS src FROM documents
            UNION ALL SELECT conv_id, turn, text, 1 FROM conversations))
    WHERE place = 1"""


def _documents_then_turns(spark, sf):
    old = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.lit(0).cast("long").alias("seq"), "text")
    new = table(spark, sf, "conversations").select(F.col("conv_id").alias("id"), F.col("turn").alias("seq"), "text")
    return old, new


@query("append_keep_last", _KEPT_SQL)
def _(spark, sf):
    return append_keep_last(*_documents_then_turns(spark, sf), order_by="seq")


@query("append_keep_last_unique", _KEPT_SQL)
def _(spark, sf):
    return append_keep_last(*_documents_then_turns(spark, sf), order_by="seq", existing_unique=True)


@query("update_table", _KEPT_SQL)
def _(spark, sf):
    old, new = _documents_then_turns(spark, sf)
    path = fresh_path(spark, "kept")
    create_keyed_table(old, path, order_by="seq", buckets=8)
    update_table(path, new, order_by="seq")
    return read_keyed_table(spark, path)


def _turn_files(spark, sf):
    """The conversations as a table of several files, in no order."""
    path = fresh_path(spark, "turns")
    table(spark, sf, "conversations").repartition(5, "turn").write.parquet(path)
    return path


_FIRST_TURNS_SQL = """
    SELECT conv_id AS id, turn, role AS title, text AS description FROM (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place FROM conversations) WHERE place = 1"""


@query("insert_repeated", f"SELECT id, turn, description AS text FROM ({_FIRST_TURNS_SQL})")
def _(spark, sf):
    """Every conversation id comes several times, from several files; the first turn is inserted."""
    turns = parquet_scan(spark, _turn_files(spark, sf)).select(F.col("conv_id").alias("id"), "turn", "text")
    path = fresh_path(spark, "inserted")
    ensure_table(spark, path, turns.schema)
    insert_into(path, turns, order_by="turn")
    insert_into(path, turns, order_by="turn")  # all ids are there now
    return parquet_scan(spark, path)


@query("insert_in_file_order", "SELECT doc_id AS id, source FROM documents")
def _(spark, sf):
    """A source without an order column: the rows of the first scan come before their changed copies."""
    path, target = fresh_path(spark, "copies"), fresh_path(spark, "inserted")
    docs = table(spark, sf, "documents", ["doc_id", "source"]).withColumnRenamed("doc_id", "id")
    changed = docs.withColumn("source", F.lit("changed"))
    both = docs.withColumn("n", F.lit(0)).unionByName(changed.withColumn("n", F.lit(1)))
    both.write.partitionBy("n").parquet(path)  # the files of n=0 come first by path
    rows = with_file_order(spark.read.parquet(path)).drop("n")
    ensure_table(spark, target, docs.schema)
    insert_into(target, rows, order_by="file_order", enrich=lambda fresh: fresh.drop("file_order"))
    return parquet_scan(spark, target)


def _turn_postings(turns):
    """Turns as postings: the conversation is the id, so ids repeat."""
    return turns.select(
        F.col("conv_id").alias("id"), "turn", F.col("role").alias("title"), F.col("text").alias("description"), F.lit(None).cast("string").alias("location"),
        F.expr("timestampadd(MINUTE, cast(turn AS INT), TIMESTAMP_NTZ '2024-01-01 00:00:00')").alias("timestamp"))


_TURNS_EMBEDDED_SQL = f"""
    WITH firsts AS (
        SELECT id, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(turn) AS timestamp, title, description, NULL::VARCHAR AS location FROM ({_FIRST_TURNS_SQL})),
    budgeted AS (SELECT id, timestamp, {truncated_sql('full_text', 1000)} AS job_info FROM (SELECT *, {POSTING_TEXT_SQL} AS full_text FROM firsts) {{where}}),
    {embedded_sql('budgeted', 'job_info')}"""


@query("embedding_repeated", _TURNS_EMBEDDED_SQL.replace("{where}", "WHERE id > 0"))
def _(spark, sf):
    stored, mark = fresh_path(spark, "embeddings"), fresh_path(spark, "mark")
    embedding_run(spark, _turn_postings(parquet_scan(spark, _turn_files(spark, sf))), stored, mark, order_by="turn")
    return embedded_rows(spark.read.parquet(stored), "job_info")


@query("stream_repeated", _TURNS_EMBEDDED_SQL.replace("{where}", ""))
def _(spark, sf):
    path = _turn_files(spark, sf)
    stream = _turn_postings(posting_stream(spark, path, spark.read.parquet(path).schema))
    stored, checkpoint = fresh_path(spark, "stream-table"), fresh_path(spark, "stream-checkpoint")
    embedding_stream(stream, stored, checkpoint, order_by="turn").awaitTermination()
    return embedded_rows(spark.read.parquet(stored), "job_info")


def _collection(spark, sf):
    path = fresh_path(spark, "collection")
    rows = table(spark, sf, "documents", ["doc_id", "text"]).select(F.col("doc_id").alias("id"), F.col("text").alias("document"))
    turns = table(spark, sf, "conversations").select(F.col("conv_id").alias("id"), F.col("text").alias("document"))

    def embed(added):
        return embed_column(added, "document")

    collection_add(rows, path, order_by="document", enrich=embed)
    collection_add(turns, path, order_by="document", enrich=embed)  # all ids are taken already
    return path


@query("document_collection", f"""
    WITH {hashed_sql(f"SELECT doc_id, {truncated_sql('text', 512)} AS text FROM documents", 'doc_id', 'text')}
    SELECT d.doc_id AS id, md5(d.text) AS document_md5, h.pos, round(h.value, 6)::DOUBLE AS value
    FROM documents d JOIN hashed h ON h.doc_id = d.doc_id""")
def _(spark, sf):
    entries = collection_get(spark, _collection(spark, sf), ("document", "embedding"))
    return embedded_rows(entries.withColumn("timestamp", F.lit(None)), "document").drop("timestamp")


@query("collection_peek", "SELECT doc_id AS id, text AS document FROM documents ORDER BY doc_id LIMIT 10")
def _(spark, sf):
    return collection_peek(spark, _collection(spark, sf)).select("id", "document")


@query("collection_count", "SELECT count(*) AS n FROM documents")
def _(spark, sf):
    return collection_count(spark, _collection(spark, sf))


def _stats_sql(relation: str) -> str:
    return f"""SELECT count(*) AS batches, sum(n)::BIGINT AS tokens, count(*) FILTER (n > 1000) AS truncations,
        sum(n) / count(*) AS mean_tokens, 0.0::DOUBLE AS cost
        FROM (SELECT {N_TOKENS_SQL.format(text='text')} AS n FROM {relation})"""


@query("run_report_append", f"{_stats_sql('documents')} UNION ALL {_stats_sql('conversations')}")
def _(spark, sf):
    path = fresh_path(spark, "run-report")
    for name in ("documents", "conversations"):
        stats = batch_stats(budget_tokens(table(spark, sf, name, ["text"])))
        run_report_append(stats.withColumn("ts", F.current_timestamp()), path)
    return run_report_scan(spark, path).select("batches", "tokens", "truncations", "mean_tokens", "cost")


@query("legacy_key", "SELECT vec_id AS id, label FROM embeddings")
def _(spark, sf):
    return rename_legacy_key(table(spark, sf, "embeddings").select(F.col("vec_id").alias("ids"), "label"))


def _embedded_sql(text: str, prefix: str, where: str = "") -> str:
    return f"""
    WITH budgeted AS (
        SELECT id, {truncated_sql('full_text', 1000)} AS {text}, timestamp
        FROM (SELECT *, {POSTING_TEXT_SQL} AS full_text FROM ({POSTINGS_SQL})) {where}),
    {embedded_sql('budgeted', text, prefix)}"""


@query("incremental_embedding", _embedded_sql("job_info", "query: ", "WHERE id > 0"))
def _(spark, sf):
    """Two runs over the same source: the second finds nothing above the mark."""
    stored, mark = fresh_path(spark, "embeddings"), fresh_path(spark, "mark")
    source = postings(spark, sf)
    embedding_run(spark, source, stored, mark, order_by="timestamp")
    embedding_run(spark, source, stored, mark, order_by="timestamp")
    return embedded_rows(spark.read.parquet(stored), "job_info")


@query("api_embedding", _embedded_sql("original", ""))
def _(spark, sf):
    path = fresh_path(spark, "api-embeddings")
    api_embedding_run(postings(spark, sf), path, "parquet")
    return embedded_rows(spark.read.parquet(path), "original")


@query("embedding_stream", _embedded_sql("job_info", "query: "))
def _(spark, sf):
    documents = table(spark, sf, "documents")
    # As a pattern, because a stream takes a plain path for a directory only.
    raw = posting_stream(spark, f"{sf}/documents.parque[t]", documents.schema)
    stream = raw.select(
        F.col("doc_id").alias("id"), F.col("source").alias("title"), F.col("text").alias("description"), F.col("lang").alias("location"),
        F.expr("timestampadd(MINUTE, cast(doc_id AS INT), TIMESTAMP_NTZ '2024-01-01 00:00:00')").alias("timestamp"),
    )
    stored = fresh_path(spark, "stream-table")
    checkpoint = fresh_path(spark, "stream-checkpoint")
    embedding_stream(stream, stored, checkpoint, order_by="timestamp").awaitTermination()
    return embedded_rows(spark.read.parquet(stored), "job_info")


@query("budgeted_postings", f"""
    SELECT id, timestamp, {truncated_sql('full_text', 1000)} AS text, {N_TOKENS_SQL.format(text='full_text')}::INTEGER AS n_tokens,
        {N_TOKENS_SQL.format(text='full_text')} > 1000 AS truncated
    FROM (SELECT *, {POSTING_TEXT_SQL} AS full_text FROM ({POSTINGS_SQL}))""")
def _(spark, sf):
    return budgeted_postings(postings(spark, sf))


@query("late_ids", """
    WITH late AS (SELECT doc_id AS id FROM documents WHERE doc_id % 7 = 3),
    marked AS (SELECT id, id >> 10 AS cell, id - row_number() OVER (PARTITION BY id >> 10 ORDER BY id) AS island FROM (SELECT DISTINCT doc_id AS id FROM documents))
    SELECT 'read' AS kind, id AS lo, id AS hi FROM late
    UNION ALL SELECT 'mark', min(id), max(id) FROM marked GROUP BY cell, island""")
def _(spark, sf):
    """A second run reads the ids that the first one did not have, low ones too, each once; then nothing is left."""
    docs = table(spark, sf, "documents", ["doc_id"]).select(F.col("doc_id").alias("id"))
    path = fresh_path(spark, "processed")
    commit_processed(spark, path, docs.filter("id % 7 <> 3"))
    late = materialise(unprocessed(docs, read_processed(spark, path)), "late-ids")
    commit_processed(spark, path, late)
    mark = read_processed(spark, path)
    again = unprocessed(docs, mark).select(F.lit("again").alias("kind"), F.col("id").alias("lo"), F.col("id").alias("hi"))
    read = late.select(F.lit("read").alias("kind"), F.col("id").alias("lo"), F.col("id").alias("hi"))
    return read.unionAll(mark.select(F.lit("mark").alias("kind"), "lo", "hi")).unionAll(again)


STATE_INSERT_SQL = """
    SELECT doc_id AS id, min(wave)::INTEGER AS wave FROM (
        SELECT doc_id, 0 AS wave FROM documents WHERE doc_id % 3 <> 0 UNION ALL SELECT doc_id, 1 FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, 2 FROM documents)
    GROUP BY doc_id"""


@query("state_insert", STATE_INSERT_SQL)
def _(spark, sf):
    """Three arrivals with repeats and late low ids through a keyed state store: the first row of each id stays."""
    docs = table(spark, sf, "documents", ["doc_id"]).select(F.col("doc_id").alias("id"))
    source, target, checkpoint = (fresh_path(spark, n) for n in ("arrivals", "state-table", "state-checkpoint"))
    for wave, rows in enumerate((docs.filter("id % 3 <> 0"), docs.filter("id % 2 = 0"), docs)):
        rows.withColumn("wave", F.lit(wave)).write.mode("append").parquet(source)
        stream = posting_stream(spark, source, T.StructType([T.StructField("id", T.LongType()), T.StructField("wave", T.IntegerType())]))
        state_insert_stream(stream, target, checkpoint, order_by="wave").awaitTermination()
    return spark.read.parquet(target).select("id", "wave")


MARKED_STREAM_SQL = """
    SELECT doc_id AS id, CASE WHEN doc_id <= 2 * m // 3 THEN 0 ELSE 2 END::INTEGER AS run, lang
    FROM documents, (SELECT max(doc_id) AS m FROM documents) WHERE doc_id > 0"""


@query("marked_stream", MARKED_STREAM_SQL)
def _(spark, sf):
    """A stream whose offset is the id mark, over a table that grows by a third: each id is read once, in the run that could first see it.

    The second run finds nothing new, and the third reads behind the mark of the first.
    """
    docs = table(spark, sf, "documents", ["doc_id", "lang", "source"]).withColumnRenamed("doc_id", "id")
    top = docs.agg(F.max("id")).first()[0] or 0
    source, target, checkpoint = (fresh_path(spark, n) for n in ("growing", "marked-table", "marked-checkpoint"))
    schema = docs.select("id", "lang").schema
    ensure_table(spark, target, T.StructType([*schema.fields, T.StructField("run", T.IntegerType())]))
    for run, arrived in enumerate((docs.filter(F.col("id") <= 2 * top // 3), docs.limit(0), docs.filter(F.col("id") > 2 * top // 3))):
        arrived.write.mode("append").parquet(source)
        stream = marked_stream(spark, source, schema).withColumn("run", F.lit(run))
        stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(target).select("id", "run", "lang")
