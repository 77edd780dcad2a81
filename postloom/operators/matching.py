"""Suitability prompts and the results of matching a CV with postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from postloom.schemas import MATCH_ANSWER, MATCH_RESULT_COLUMNS

# Categories from best to worst, and the prompt layout.
SUITABILITY = (
    "Highly Suitable",
    "Moderately Suitable",
    "Potentially Suitable",
    "Marginally Suitable",
    "Not Suitable",
)
CV_DELIMITER = "####"
ID_MARKS = "<>"
TEXT_DELIMITER = "---"
POSTINGS_HEADING = "Available job openings:"


def default_match_instructions() -> str:
    return (
        f"Judge how well the CV between {CV_DELIMITER} marks suits each job opening. An opening is given as its id in "
        f"angle brackets and its text between {TEXT_DELIMITER} marks. Use one of the categories {', '.join(SUITABILITY)}. "
        "Answer with a JSON list of objects with the keys id, suitability and explanation (one sentence)."
    )


def category_rank(col) -> Column:
    """1 for the best category; unknown labels sort last."""
    name = F.col(col) if isinstance(col, str) else col
    rank = None
    for position, category in enumerate(SUITABILITY, start=1):
        rank = F.when(name == category, position) if rank is None else rank.when(name == category, position)
    return rank.otherwise(len(SUITABILITY) + 1)


def match_prompt(nearest: DataFrame, postings: DataFrame, cvs: DataFrame, instructions: str | None = None, text_col: str = "text") -> DataFrame:
    """``(query_id, prompt)``: instructions, the CV, then its nearest postings by rank.

    ``nearest`` is the output of ``nearest_postings``; a prompt therefore collects k rows.
    Posting texts are fetched by a join on the chosen ids only.
    """
    chosen = nearest.join(postings.select("id", F.col(text_col).alias("_text")), "id")
    entry = F.concat(F.lit(ID_MARKS[0]), F.col("id").cast("string"), F.lit(ID_MARKS[1] + " " + TEXT_DELIMITER), F.col("_text"), F.lit(TEXT_DELIMITER))
    listed = chosen.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", entry.alias("entry")))).alias("_entries"))
    body = F.array_join(F.transform("_entries", lambda e: e["entry"]), "\n")
    head = (instructions if instructions is not None else default_match_instructions()) + "\n\n"
    return cvs.join(listed, "query_id").select(
        "query_id",
        F.concat(F.lit(head + CV_DELIMITER), F.col(text_col), F.lit(f"{CV_DELIMITER}\n\n{POSTINGS_HEADING}\n\n"), body).alias("prompt"),
    )


def match_answers(answers: DataFrame, answer_col: str = "answer") -> DataFrame:
    """One row per judged posting; broken JSON gives none."""
    kept = [c for c in answers.columns if c != answer_col]
    parsed = answers.select(*kept, F.explode_outer(F.from_json(answer_col, MATCH_ANSWER)).alias("_a"))
    return parsed.select(*kept, "_a.id", "_a.suitability", "_a.explanation").filter("id IS NOT NULL")


def match_results(answers: DataFrame, postings: DataFrame, answer_col: str = "answer", ordered: bool = True) -> DataFrame:
    """Judged postings with their columns, best category first and then by id.

    Answers about an unknown id drop out. A posting judged very often makes a skewed join
    key on the answer side only; adaptive execution splits such a partition.
    """
    judged = match_answers(answers, answer_col)
    joined = judged.join(postings, "id").withColumn("category_rank", category_rank("suitability"))
    extra = [c for c in joined.columns if c not in MATCH_RESULT_COLUMNS and c != "category_rank"]
    present = [c for c in MATCH_RESULT_COLUMNS if c in joined.columns]
    result = joined.select(*extra, *present, "category_rank")
    return result.orderBy("category_rank", "id", *extra) if ordered else result
