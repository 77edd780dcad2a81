"""From postings and CVs to prompts and ordered suitability results."""

from __future__ import annotations

from pyspark.sql import DataFrame

from postloom import hooks
from postloom.operators.filters import country_filter, recent_filter
from postloom.operators.matching import match_prompt
from postloom.operators.search import nearest_postings, query_vector


def eligible_postings(postings: DataFrame, as_of=None, countries: DataFrame | None = None, literal: bool = False) -> DataFrame:
    """Recent postings, limited to one country's values when given."""
    recent = recent_filter(postings, as_of)
    return recent if countries is None else country_filter(recent, countries, literal=literal)


def prompts_for_cvs(
    embedded: DataFrame,
    cvs: DataFrame,
    k: int = 10,
    encoder: hooks.EncoderFactory | None = None,
    dim: int = 64,
    instructions: str | None = None,
    text_col: str = "job_info",
) -> DataFrame:
    """``(query_id, prompt)`` for ``cvs (query_id, text)`` over the embedding table."""
    nearest = nearest_postings(embedded.select("id", "embedding"), query_vector(cvs, "text", encoder, dim), k)
    return match_prompt(nearest, embedded.select("id", embedded[text_col].alias("text")), cvs, instructions)
