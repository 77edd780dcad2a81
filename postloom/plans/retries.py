"""Retries across runs: a stored schedule of attempts in place of threads that wait.

The attempts table is append-only, a row for each call of the service. Attempt counts, the
times from which requests are due again and the dead letters follow from it by one
aggregate, so they outlive the run, and a run never waits: it asks what is due and ends.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from postloom import hooks
from postloom.operators.chat import MAX_ATTEMPTS, REQUEST_KINDS, outcome, parse_responses
from postloom.plans.summaries import WAVE_REQUESTS, SummaryRun, keyed_requests, long_requests, request_waves
from postloom.sources.tables import ensure_table

ATTEMPTS = "key string, attempt int, asked_at timestamp, summary string, prompt_tokens int, completion_tokens int, cost double"
# Seconds before the second attempt; the n-th failure is followed by this to the power of n.
BACKOFF = 5.0


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def _at(moment: datetime) -> Column:
    return F.timestamp_micros(F.lit(round(moment.timestamp() * 1_000_000)).cast("long"))


def request_schedule(spark: SparkSession, path: str, max_attempts: int = MAX_ATTEMPTS, backoff: float = BACKOFF) -> DataFrame:
    """``(key, attempts, asked_at, state, due, summary, cost)`` of each request that was ever asked.

    ``state`` is ``answered``; ``waiting``, and then ``due`` is the time from which it is
    asked again; or ``dead`` after ``max_attempts`` failures. ``asked_at`` is the last call.
    Of several answers the first attempt's counts. Without a table there are no rows.
    """
    ensure_table(spark, path, spark.createDataFrame([], ATTEMPTS).schema)
    usable = F.col("summary").isNotNull()
    first = F.min(F.when(usable, F.struct("attempt", "summary", "cost")))
    calls = spark.read.schema(ATTEMPTS).parquet(path).groupBy("key").agg(
        F.max("attempt").alias("attempts"), F.max("asked_at").alias("asked_at"), F.bool_or(usable).alias("_answered"), first.alias("_first"))
    # Not by the answer itself, which is then read only where it is asked for.
    state = F.when(F.col("_answered"), "answered").when(F.col("attempts") >= max_attempts, "dead").otherwise("waiting")
    wait = F.round(F.pow(F.lit(float(backoff)), F.col("attempts")) * 1_000_000).cast("long")
    due = F.when(state == "waiting", F.timestamp_micros(F.unix_micros("asked_at") + wait))
    return calls.select("key", "attempts", "asked_at", state.alias("state"), due.alias("due"), F.col("_first.summary").alias("summary"), F.col("_first.cost").alias("cost"))


def dead_letters(spark: SparkSession, path: str, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """``(key, attempts, asked_at)`` of the requests that failed ``max_attempts`` times."""
    return request_schedule(spark, path, max_attempts).filter("state = 'dead'").select("key", "attempts", "asked_at")


def ask_due(
    requests: DataFrame,
    call,
    path: str,
    model: str,
    clock: Callable[[], datetime] = utc_now,
    max_attempts: int = MAX_ATTEMPTS,
    backoff: float = BACKOFF,
    wave_requests: int = WAVE_REQUESTS,
) -> float:
    """Ask each of ``requests (key, request)`` once that is new or due; the cost of this run.

    ``call`` makes one attempt (``complete_udf(attempts=1)``). Answers and failures are
    appended wave by wave, under the time at which the wave began. A run that dies loses the
    wave it was in: its calls are made again and do not count as attempts. Keys may repeat.
    """
    spark = requests.sparkSession
    known = request_schedule(spark, path, max_attempts, backoff).select("key", "attempts", "state", "due")
    ready = F.col("state").isNull() | ((F.col("state") == "waiting") & (F.col("due") <= _at(clock())))
    due = requests.select("key").distinct().join(known, "key", "left").filter(ready).select("key", F.coalesce("attempts", F.lit(0)).alias("before"))
    total = 0.0
    for part in request_waves(requests, due, wave_requests):
        asked_at = _at(clock())
        answered = part.select("key", "before", call(F.col("request")).alias("_answer")).select("key", "before", "_answer.response")
        parsed = parse_responses(answered, model).select(
            "key", (F.col("before") + 1).cast("int").alias("attempt"), asked_at.alias("asked_at"), "summary",
            F.col("prompt_tokens").cast("int"), F.col("completion_tokens").cast("int"), "cost")
        cost = Observation()
        parsed.observe(cost, F.sum(F.col("cost").cast("decimal(20,3)")).alias("cost")).write.mode("append").parquet(path)
        total += float(cost.get["cost"] or 0)
    return total


def scheduled_run(
    texts: DataFrame,
    completion: hooks.CompletionFactory,
    path: str,
    kind: str = "job",
    model: str | None = None,
    instructions: str | None = None,
    max_attempts: int = MAX_ATTEMPTS,
    backoff: float = BACKOFF,
    pause: float = 0.5,
    concurrency: int = 8,
    clock: Callable[[], datetime] = utc_now,
    wave_requests: int = WAVE_REQUESTS,
) -> SummaryRun:
    """``summary_run`` that makes one attempt per request and run, and keeps a schedule in ``path``.

    ``summaries`` has ``attempts`` (0 for short texts) and ``due`` beside the columns of
    ``outcome``; a text whose request is asked again later has the status ``waiting`` and,
    like a failed one, itself as the summary. Null texts count as short.
    """
    started, spark = time.monotonic(), texts.sparkSession
    model = model or REQUEST_KINDS[kind]["model"]
    call = hooks.complete_udf(completion, 1, backoff, pause, concurrency)
    keyed = keyed_requests(texts, kind, instructions, model)
    total = ask_due(long_requests(keyed), call, path, model, clock, max_attempts, backoff, wave_requests)
    known = request_schedule(spark, path, max_attempts, backoff).select(
        "key", F.col("summary").alias("_summary"), F.col("cost").alias("_cost"), "attempts", "state", "due")
    joined = keyed.drop("request").join(known, "key", "left").withColumn("attempts", F.coalesce("attempts", F.lit(0)))
    status = F.when(F.col("state") == "waiting", "waiting").otherwise(F.col("status"))
    summaries = outcome(joined, extra=("attempts", "due", "state")).withColumn("status", status).drop("state")
    return SummaryRun(summaries, total, time.monotonic() - started)
