"""Summarising texts through a completion service."""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from postloom import hooks
from postloom.operators.chat import MAX_ATTEMPTS, REQUEST_KINDS, build_requests, is_long, outcome, parse_responses, request_json, request_key
from postloom.operators.sieve import Sieve
from postloom.session import fresh_path, materialise
from postloom.sources.tables import ensure_table, run_report_append

ANSWERS = "key string, summary string, prompt_tokens int, completion_tokens int, cost double"
# Requests that are answered before their answers are stored.
WAVE_REQUESTS = 10_000
# Files of all waves together; a wave has one for each task that may run at a time, if that is not more.
MOST_FILES = 4_096


@dataclass(frozen=True)
class SummaryRun:
    summaries: DataFrame
    total_cost: float
    seconds: float


def request_waves(requests: DataFrame, due: DataFrame, wave_requests: int) -> Iterator[DataFrame]:
    """The ``requests (key, request)`` whose key is ``due``, each key once, in parts of about ``wave_requests``.

    ``due`` has different keys, and columns that its rows bring along. Requests are
    shuffled and written once, a folder of several files for each wave; a wave reads its
    own folder only, without a shuffle: the work does not grow with the number of waves.
    A sieve of the due keys keeps most other requests where they are read.
    """
    spark = requests.sparkSession
    # Written before the waves are cut, because their number follows from the rows.
    due = materialise(due, "due-keys")
    asked = due.count()
    waves = -(-asked // wave_requests)
    if not waves:
        return
    files = max(1, min(spark.sparkContext.defaultParallelism, MOST_FILES // waves))
    parts = waves * files
    hashed = F.xxhash64("key")
    near = Sieve.of(due, hashed, at_most=asked).mark(requests, hashed, "_near").filter("_near").drop("_near")
    # Both sides and the copies of a key meet in the partition that writes them.
    met = near.repartition(parts, "key").join(due.repartition(parts, "key"), "key").dropDuplicates(["key"])
    without = due.filter("key IS NULL")
    if not without.isEmpty():
        met = met.unionByName(requests.filter("key IS NULL").limit(1).drop("key").crossJoin(without))
    path = fresh_path(spark, "request-waves")
    wave = F.pmod(F.spark_partition_id(), F.lit(waves))
    met.select(*due.columns, "request", wave.alias("wave")).write.partitionBy("wave").parquet(path)
    rows = spark.read.schema(StructType([*due.schema.fields, StructField("request", StringType()), StructField("wave", IntegerType())])).parquet(path)
    # A wave without requests has no folder.
    for number in sorted(row["wave"] for row in rows.select("wave").distinct().collect()):
        yield spark.read.schema(rows.drop("wave").schema).parquet(f"{path}/wave={number}")


def answer_requests(requests: DataFrame, call, answers_path: str, model: str, wave_requests: int = WAVE_REQUESTS) -> float:
    """Ask what the table at ``answers_path`` has no usable answer to; the cost of this run.

    ``requests (key, request)`` may repeat: each key is asked once. Answers are parsed and
    appended in waves of about ``wave_requests``, so a run that dies loses one wave, and the
    next run asks only for the rest. Failed requests are stored without a summary and asked
    again by a later run (``plans.retries`` has the form that keeps a schedule).
    """
    spark = requests.sparkSession
    ensure_table(spark, answers_path, spark.createDataFrame([], ANSWERS).schema)
    usable = spark.read.schema(ANSWERS).parquet(answers_path).filter("summary IS NOT NULL").select("key")
    due = requests.select("key").distinct().join(usable, "key", "left_anti")
    total = 0.0
    for part in request_waves(requests, due, wave_requests):
        answered = part.select("key", call(F.col("request")).alias("_answer")).select("key", "_answer.response")
        parsed = parse_responses(answered, model).select("key", "summary", F.col("prompt_tokens").cast("int"), F.col("completion_tokens").cast("int"), "cost")
        cost = Observation()
        parsed.observe(cost, F.sum(F.col("cost").cast("decimal(20,3)")).alias("cost")).write.mode("append").parquet(answers_path)
        total += float(cost.get["cost"] or 0)
    return total


def keyed_requests(texts: DataFrame, kind: str, instructions: str | None, model: str) -> DataFrame:
    """``(id, text, request, _long, key)`` of ``texts (id, text)``; equal requests have one key."""
    asked = request_json(build_requests(texts.select("id", "text"), kind, "text", instructions, model))
    # Short texts have keys of their own, so that they spread over the tasks of the join.
    return asked.select("id", "text", "request", is_long().alias("_long")).withColumn(
        # Never null, and said to be so: else joins add a filter that computes every key a second time.
        "key", F.coalesce(F.when(F.col("_long"), request_key()).otherwise(F.concat(F.lit("short "), F.xxhash64("id").cast("string"))), F.lit("")))


def long_requests(keyed: DataFrame) -> DataFrame:
    """``(key, request)`` of the texts that are asked; their key without asking again whether they are long."""
    return keyed.filter("_long").select(F.coalesce(request_key(), F.lit("")).alias("key"), "request")


def summary_run(
    texts: DataFrame,
    completion: hooks.CompletionFactory,
    answers_path: str,
    kind: str = "job",
    model: str | None = None,
    instructions: str | None = None,
    attempts: int = MAX_ATTEMPTS,
    backoff: float = 5.0,
    pause: float = 0.5,
    concurrency: int = 8,
    report_path: str | None = None,
    wave_requests: int = WAVE_REQUESTS,
) -> SummaryRun:
    """Summaries of ``texts (id, text)``; ``total_cost`` is what this run paid.

    Only texts that pass the length gate reach the service, equal ones once, and none that
    the answer table at ``answers_path`` holds already. ``summaries`` joins the texts to
    that table and is ready for a sink.
    """
    started = time.monotonic()
    spark = texts.sparkSession
    model = model or REQUEST_KINDS[kind]["model"]
    call = hooks.complete_udf(completion, attempts, backoff, pause, concurrency)
    keyed = keyed_requests(texts, kind, instructions, model)
    total = answer_requests(long_requests(keyed), call, answers_path, model, wave_requests)
    answers = spark.read.schema(ANSWERS).parquet(answers_path).filter("summary IS NOT NULL").dropDuplicates(["key"])
    answers = answers.select("key", F.col("summary").alias("_summary"), F.col("cost").alias("_cost"))
    summaries = outcome(keyed.drop("request").join(answers, "key", "left"))
    seconds = time.monotonic() - started
    if report_path:
        totals = spark.createDataFrame([(total, seconds)], "total_cost double, seconds double")
        run_report_append(totals.withColumn("ts", F.current_timestamp()), report_path)
    return SummaryRun(summaries, total, seconds)
