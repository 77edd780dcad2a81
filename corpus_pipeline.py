"""The training-data pipeline: five stages from documents to token shards."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from postloom.llm import decontamination, language_id, minhash, mixing
from postloom.llm.queries import EPOCHS, MIXTURE, training_order
from postloom.session import fresh_path, materialise, ship_packages

# Similarity in percent from which documents count as copies.
NEAR_PERCENT = 80


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; those without text or letters go.

    The machines know no "other": every text with a letter gets a learned language and stays.
    Repeated rows stay, rows without key too; an empty table gives none.
    """
    ship_packages(spark, "postloom")
    return language_id.keep_identified(docs, language_id.fit_languages(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies, the smallest key.

    Texts without words are copies of nothing. Rows without key stay; of rows that repeat a
    key all stay or none. An empty table gives none.
    """
    ship_packages(spark, "postloom")
    return minhash.drop_near_duplicates(docs, percent=NEAR_PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item: its words, a copy with few edits, or other fillers.

    Rows that repeat a key go together; rows without key and null texts stay. Without
    benchmark items all stay.
    """
    ship_packages(spark, "postloom")
    found = decontamination.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return minhash.drop_keys(docs, materialise(found.select(F.col("doc_id").alias("key")).distinct(), "contaminated"), "doc_id")


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, each as often as its rate says: toxic ones go, good ones may come twice.

    A null text counts as empty and has the rate of the priors. Equal rows have equal rates
    and draws. Without labels all domains are alike; an empty table gives none.
    """
    ship_packages(spark, "postloom")
    _, mixture = mixing.mix(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), MIXTURE, EPOCHS)
    return mixing.resample(docs, mixture)


def order_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences in training order, from the shard files that were written.

    Null and empty texts are one sequence, the end token. Rows that repeat a key or have
    none get places by their text. An empty table gives none.
    """
    ship_packages(spark, "postloom")
    return training_order(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify_languages),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix_domains),
    ("token-ID / binary output", order_tokens),
]

# Language, near-duplicate and rate decisions come from fitted models and confirmed hashes,
# which SQL cannot express; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name.split()[0].lower())
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
