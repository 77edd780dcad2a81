"""Requests to and answers from a completion service, as table columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from postloom.functions.money import completion_cost
from postloom.operators.filters import MIN_WORDS, needs_summary
from postloom.schemas import CHAT_RESPONSE

# Delimiters and labels of the requests, and the model settings.
JOB_DELIMITER = "----"
SECTION_DELIMITER = "####"
CV_DELIMITER = "####"
JOB_LABELS = (
    "Title",
    "Location",
    "Job Objective",
    "Responsibilities/Key duties",
    "Qualifications/Requirements/Experience",
    "Preferred Skills/Nice to Have",
    "About the company",
    "Compensation and Benefits",
)
JOB_LABELS_SINGLE = (
    "Title",
    "Location",
    "Job Objective",
    "Responsibilities/Key duties",
    "Qualifications/Requirements",
    "Preferred Skills/Experience",
    "About the company",
    "Compensation and Benefits",
)
CV_LABELS = (
    "Qualifications",
    "Previous job titles",
    "Responsibilities/Key Duties",
    "Skills",
    "Other Achivements",
)
REQUEST_KINDS = {
    "job": {"labels": JOB_LABELS, "model": "gpt-3.5-turbo", "max_tokens": 400},
    "job_single": {"labels": JOB_LABELS_SINGLE, "model": "gpt-3.5-turbo", "max_tokens": 350},
    "cv": {"labels": CV_LABELS, "model": "gpt-3.5-turbo-16k", "max_tokens": 4000},
}
MAX_ATTEMPTS = 5


def default_instructions(kind: str) -> str:
    labels = "\n".join(f"{label}:" for label in REQUEST_KINDS[kind]["labels"])
    if kind == "cv":
        return f"Summarise the CV between {CV_DELIMITER} marks in no more than 200 words. Fill in this form:\n\n{labels}\n"
    return (
        f"Summarise the job opening between {JOB_DELIMITER} marks. Its title, location and description "
        f"are enclosed in {SECTION_DELIMITER} marks. Fill in this form:\n\n{labels}\n"
    )


def user_content(text, kind: str) -> Column:
    head, mark = ("CV: ", CV_DELIMITER) if kind == "cv" else ("Job Opening: ", JOB_DELIMITER)
    return F.concat(F.lit(head + mark), F.col(text) if isinstance(text, str) else text, F.lit(mark))


def build_requests(df: DataFrame, kind: str = "job", text_col: str = "text", instructions: str | None = None, model: str | None = None) -> DataFrame:
    """Add ``messages``, ``model``, ``temperature`` and ``max_tokens``."""
    settings = REQUEST_KINDS[kind]

    def message(content):
        return F.struct(F.lit("user").alias("role"), content.alias("content"))

    fixed = F.lit(instructions if instructions is not None else default_instructions(kind))
    return (
        df.withColumn("messages", F.array(message(fixed), message(user_content(text_col, kind))))
        .withColumn("model", F.lit(model or settings["model"]))
        .withColumn("temperature", F.lit(0))
        .withColumn("max_tokens", F.lit(settings["max_tokens"]))
    )


def request_json(df: DataFrame, output_col: str = "request") -> DataFrame:
    return df.withColumn(output_col, F.to_json(F.struct("messages", "model", "temperature", "max_tokens")))


def parse_responses(df: DataFrame, model="gpt-3.5-turbo", response_col: str = "response") -> DataFrame:
    """Add ``summary``, ``prompt_tokens``, ``completion_tokens`` and ``cost``.

    A broken, empty or incomplete response gives NULL in all four columns. ``model`` is a
    model name, or a column with one.
    """
    name = F.lit(model) if isinstance(model, str) else model
    parsed = df.withColumn("_r", F.from_json(response_col, CHAT_RESPONSE))
    content = F.get("_r.choices", F.lit(0))["message"]["content"]
    complete = content.isNotNull() & F.col("_r.usage.prompt_tokens").isNotNull() & F.col("_r.usage.completion_tokens").isNotNull()
    parsed = (
        parsed.withColumn("summary", F.when(complete, content))
        .withColumn("prompt_tokens", F.when(complete, F.col("_r.usage.prompt_tokens")))
        .withColumn("completion_tokens", F.when(complete, F.col("_r.usage.completion_tokens")))
        .drop("_r")
    )
    cost = completion_cost("prompt_tokens", "completion_tokens", name)
    return parsed.withColumn("cost", F.when(F.col("prompt_tokens").isNotNull(), cost))


def summarise_with_fallback(
    texts: DataFrame,
    responses: DataFrame,
    model="gpt-3.5-turbo",
    key: str = "id",
    text_col: str = "text",
    attempt_col: str | None = None,
    max_attempts: int = MAX_ATTEMPTS,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """``(key, original, summary, cost, status)`` for every text.

    Texts of at most ``min_words`` words pass through as ``short``. The others take the
    first usable response among the first ``max_attempts`` attempts (``ok``), or fall back
    to the original text at cost 0 (``failed``).
    """
    attempts = responses if attempt_col is None else responses.filter(F.col(attempt_col) <= max_attempts)
    # Usable answers sort first, so that no filter has to parse the responses a second time.
    order = [F.col("summary").isNull()] + ([F.col(attempt_col)] if attempt_col else []) + [F.col("summary")]
    parsed = parse_responses(attempts, model)
    first = parsed.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("_rank = 1")
    usable = first.select(F.col(key), F.col("summary").alias("_summary"), F.col("cost").alias("_cost"))
    gated = texts.withColumn("_long", is_long(text_col, min_words))
    return outcome(gated.join(usable, key, "left"), key, text_col)


def is_long(text_col: str = "text", min_words: int = MIN_WORDS) -> Column:
    return F.coalesce(needs_summary(F.col(text_col), min_words), F.lit(False))


def request_key(request_col: str = "request") -> Column:
    """What an answer is stored under: equal requests have one answer."""
    return F.sha2(request_col, 256)


def outcome(df: DataFrame, key: str = "id", text_col: str = "text", extra: tuple[str, ...] = ()) -> DataFrame:
    """The result rows of texts that carry ``_long``, ``_summary`` and ``_cost``, and their columns ``extra``."""
    taken = F.col("_long") & F.col("_summary").isNotNull()
    return df.select(
        key,
        F.col(text_col).alias("original"),
        F.when(taken, F.col("_summary")).otherwise(F.col(text_col)).alias("summary"),
        F.when(taken, F.col("_cost")).otherwise(F.lit(0.0)).alias("cost"),
        F.when(~F.col("_long"), "short").when(taken, "ok").otherwise("failed").alias("status"),
        *extra,
    )
