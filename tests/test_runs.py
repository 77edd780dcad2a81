import inspect
import json

import pytest
from pyspark.sql import functions as F, types as T

from postloom.__main__ import main
from postloom.plans import embedding as runs
from postloom.plans.summaries import answer_requests
from postloom.schemas import POSTINGS, RUN_REPORT
from postloom.session import fresh_path, materialise, shared_dir
from postloom.sources.collection import collection_count, collection_peek
from postloom.sources.jdbc import jdbc_insert, jdbc_options, jdbc_write_options, rows_to_insert, vector_text
from postloom.sources.postings import incremental_scan, watermark_advance
from postloom.sources.tables import csv_scan, csv_sink, run_report_scan
from postloom.sources.watermark import commit_watermark, read_watermark, watermark_table
from postloom.streaming.increments import embedding_stream, posting_stream, state_insert_stream


def postings(spark, *ids):
    return spark.createDataFrame([(i, f"title {i}", "some (words), here", None) for i in ids],
                                 "id long, title string, description string, location string").withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))


def test_scan_is_strict_and_pushed_down(spark, plan):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    scanned = incremental_scan(docs, 5, columns=("doc_id", "lang"), key="doc_id")
    text = plan(scanned)
    assert "GreaterThan(doc_id,5)" in text and "ReadSchema: struct<doc_id:bigint,lang:string>" in text
    assert scanned.agg(F.min("doc_id")).first()[0] == 6
    assert watermark_advance(postings(spark), 9).first()["max_id"] == 9
    assert [r["id"] for r in incremental_scan(postings(spark, 1, 2, 3), 1, upper_id=2).collect()] == [2]


def test_watermark_versions(spark):
    path = fresh_path(spark, "mark")
    assert read_watermark(spark, path) == 0
    for mark in (10, 25, 0):  # the last commit restarts the count
        commit_watermark(spark, path, mark)
    assert read_watermark(spark, path) == 0
    commit_watermark(spark, path, 30)
    assert watermark_table(spark, path).first()["max_id"] == 30


def test_embedding_run_repeats_safely(spark, monkeypatch):
    table, mark, report = (fresh_path(spark, n) for n in ("table", "mark", "report"))
    first = runs.embedding_run(spark, postings(spark, 1, 2), table, mark, order_by="timestamp", dim=8, report_path=report)
    assert (first.initial_count, first.jobs_added, first.final_count, first.max_id) == (0, 2, 2, 2)

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(runs, "commit_watermark", dies)
        with pytest.raises(RuntimeError):
            runs.embedding_run(spark, postings(spark, 1, 2, 3), table, mark, order_by="timestamp", dim=8)
    assert read_watermark(spark, mark) == 2

    again = runs.embedding_run(spark, postings(spark, 1, 2, 3, 4), table, mark, order_by="timestamp", dim=8, report_path=report)
    assert (again.initial_count, again.jobs_added, again.final_count, again.max_id) == (3, 1, 4, 4)
    idle = runs.embedding_run(spark, postings(spark, 1, 2, 3, 4), table, mark, order_by="timestamp", dim=8)
    assert (idle.jobs_added, idle.final_count, idle.max_id) == (0, 4, 4)

    stored = spark.read.parquet(table)
    assert stored.columns == ["id", "job_info", "timestamp", "embedding"]
    assert sorted(r["id"] for r in stored.collect()) == [1, 2, 3, 4]
    assert "location: None" in stored.first()["job_info"] and "(" not in stored.first()["job_info"]
    reports = run_report_scan(spark, report)
    assert reports.schema == RUN_REPORT and reports.count() == 2


def test_encoder_sees_only_rows_that_are_inserted(spark):
    table, mark = fresh_path(spark, "table"), fresh_path(spark, "mark")
    texts = spark.sparkContext.accumulator(0)

    def factory():
        def encode(batch):
            texts.add(len(batch))
            return [[1.0] for _ in batch]

        return encode

    runs.embedding_run(spark, postings(spark, 1, 2, 3, 3), table, mark, order_by="timestamp", encoder=factory)
    assert texts.value == 3
    commit_watermark(spark, mark, 0)  # read everything again
    report = runs.embedding_run(spark, postings(spark, 1, 2, 3, 4), table, mark, order_by="timestamp", encoder=factory)
    assert (report.jobs_added, texts.value) == (1, 4)


def test_api_run_sinks(spark):
    source = postings(spark, 1, 2)
    paths = {sink: fresh_path(spark, sink) for sink in ("parquet", "csv", "collection")}
    for sink, path in paths.items():
        runs.api_embedding_run(source, path, sink, order_by="timestamp", dim=4)
    assert spark.read.parquet(paths["parquet"]).columns == ["id", "original", "embedding", "timestamp"]
    rows = csv_scan(spark, paths["csv"], "id long, original string, embedding string").collect()
    assert len(json.loads(rows[0]["embedding"])) == 4
    runs.api_embedding_run(postings(spark, 2, 3), paths["collection"], "collection", order_by="timestamp", dim=4)
    assert collection_count(spark, paths["collection"]).first()["n"] == 3
    assert [r["id"] for r in collection_peek(spark, paths["collection"], 2).collect()] == [1, 2]
    with pytest.raises(ValueError):
        runs.api_embedding_run(source, paths["csv"], "other")


def test_csv_round_trip(spark):
    texts = ['a "quoted", text\nwith\r\nlines ', "  blanks  ", "back\\slash", "", None, "tab\t"]
    path = fresh_path(spark, "csv")
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)], "id long, original string, summary string")
    csv_sink(df, path)
    rows = csv_scan(spark, path, "id long, original string, summary string").orderBy("id").collect()
    assert [r["original"] for r in rows] == texts


def test_stream_takes_late_low_ids(spark):
    source, table, checkpoint = (fresh_path(spark, n) for n in ("source", "table", "checkpoint"))
    for batch in ((5, 6), (1, 6)):  # id 1 arrives late, id 6 again
        rows = postings(spark, *batch).select(*[F.col(f.name).cast(f.dataType) for f in POSTINGS.fields])
        rows.coalesce(1).write.mode("append").parquet(source)
        embedding_stream(posting_stream(spark, source, POSTINGS, max_files=1), table, checkpoint, order_by="timestamp", dim=4).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(table).collect()) == [1, 5, 6]


def test_jdbc_options_cut_the_new_range():
    options = jdbc_options("jdbc:postgresql://host/db", "postings", 100, 900, 8, user="u")
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"], options["user"]) == ("101", "900", "8", "u")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", 0, 1, 0)


def test_jdbc_writes_vectors_as_text(spark):
    df = spark.createDataFrame([([1.0, -2.5],), ([],)], "embedding array<float>")
    assert [r[0] for r in df.select(vector_text("embedding")).collect()] == ["[1.0,-2.5]", "[]"]
    options = jdbc_write_options("jdbc:x", "t", 500, user="u")
    assert (options["batchsize"], options["stringtype"], options["user"]) == ("500", "unspecified", "u")


def test_jdbc_insert_takes_first_rows_of_new_keys(spark):
    stored = spark.createDataFrame([(1,), (5,)], "id long")
    new = spark.createDataFrame([(1, 1, [1.0]), (2, 9, [2.0]), (2, 3, [3.0]), (7, 1, None)], "id long, seq int, embedding array<float>")
    rows = rows_to_insert(stored, new, order_by="seq").collect()
    assert sorted((r["id"], r["seq"], r["embedding"]) for r in rows) == [(2, 3, "[3.0]"), (7, 1, None)]
    assert "order_by" in inspect.signature(jdbc_insert).parameters
    jdbc_insert(new.limit(0), "jdbc:none://nowhere", "t", 2, order_by="seq")  # nothing to insert: no connection


def test_state_store_inserts_once(spark):
    source, target, checkpoint = (fresh_path(spark, n) for n in ("source", "target", "checkpoint"))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("seq", T.IntegerType()), T.StructField("text", T.StringType())])
    for batch in ([(5, 2, "b"), (5, 1, "a"), (None, 1, "n")], [(1, 9, "late"), (5, 0, "again")], [(1, 1, "x"), (6, 1, None)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        state_insert_stream(posting_stream(spark, source, schema), target, checkpoint, order_by="seq").awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(target).collect())) == [(1, 9, "late"), (5, 1, "a"), (6, 1, None)]


def test_waves_read_their_own_folder(spark):
    requests = spark.createDataFrame([(f"k{i % 40}", f'{{"n": {i % 40}}}') for i in range(100)], "key string, request string")
    answer = F.udf(lambda r: "{}", "string")
    call = lambda column: F.struct(F.lit(1).alias("attempts"), answer(column).alias("response"))
    path = fresh_path(spark, "answers")
    answer_requests(requests, call, path, "m", wave_requests=10)
    stored = spark.read.parquet(path)
    assert stored.count() == 40 and stored.select("key").distinct().count() == 40


def test_shared_folder(spark):
    assert fresh_path(spark, "x").startswith(shared_dir(spark)) and fresh_path(spark, "x") != fresh_path(spark, "x")
    assert materialise(spark.range(3), "three").count() == 3


def test_command_line(spark, capsys):
    source, table, mark, flat = (fresh_path(spark, n) for n in ("source", "table", "mark", "flat"))
    postings(spark, 3, 4).write.parquet(source)
    main(["embed", "--postings", source, "--output", table, "--watermark", mark, "--dim", "4", "--tokenizer", "tests.test_texts:byte_tokenizer"])
    assert "jobs_added=2" in capsys.readouterr().out and read_watermark(spark, mark) == 4
    main(["api-embed", "--postings", source, "--output", flat, "--encoder", "tests.test_vectors:length_encoder"])
    assert spark.read.parquet(flat).count() == 2
