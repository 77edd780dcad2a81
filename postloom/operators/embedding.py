"""Embedding columns: encoding, assembling, pooling and checking vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from postloom import hooks
from postloom.functions.text import e5_prefix
from postloom.functions.tokens import truncate_tokens
from postloom.functions.vectors import hashed_vector

E5_CHUNK = 15
API_CHUNK = 50
# Tokens that the model reads; the rest of a text has no part in its vector.
MODEL_TOKENS = 512


def embed_column(
    df: DataFrame,
    text_col: str = "text",
    output_col: str = "embedding",
    encoder: hooks.EncoderFactory | None = None,
    dim: int = 64,
    chunk: int = E5_CHUNK,
    max_input_tokens: int = MODEL_TOKENS,
    tokenizer: hooks.TokenizerFactory | None = None,
) -> DataFrame:
    """Add a vector per text, from the encoder hook or the built-in hashing encoder.

    The first ``max_input_tokens`` tokens are encoded; the text column stays whole. Rows
    stay where they are: there is no shuffle and no order to restore. Without hooks the
    vector is a column expression.
    """
    if encoder is None and tokenizer is None:
        return df.withColumn(output_col, hashed_vector(F.col(text_col), dim, max_input_tokens))
    read = truncate_tokens(text_col, max_input_tokens, None, tokenizer)
    return df.withColumn(output_col, hooks.encode_udf(encoder, chunk)(read) if encoder else hashed_vector(read, dim))


def assemble_embeddings(df: DataFrame, encoder: hooks.EncoderFactory | None = None, kind: str = "query", dim: int = 64, chunk: int = E5_CHUNK, **limits) -> DataFrame:
    """``(id, job_info, timestamp, embedding)`` from budgeted postings with column ``text``.

    The vector is made from the prefixed text while ``job_info`` keeps the plain one.
    ``limits`` are ``max_input_tokens`` and ``tokenizer`` of ``embed_column``.
    """
    prefixed = df.select("id", F.col("text").alias("job_info"), "timestamp", e5_prefix("text", kind).alias("_input"))
    return embed_column(prefixed, "_input", "embedding", encoder, dim, chunk, **limits).drop("_input")


def dimension_check(df: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """``(dim, n)``: a sound table gives exactly one row."""
    return df.groupBy(F.size(vector_col).alias("dim")).agg(F.count(F.lit(1)).alias("n"))


def mean_pool(df: DataFrame, seq_col: str = "seq_id", vector_col: str = "vec", mask_col: str = "mask") -> DataFrame:
    """``(seq, embedding)``: mean over the unmasked token vectors; NULL elements if all are masked.

    The vectors are unrolled into ``(sequence, position)`` groups, whose sums are combined in
    each task, so a long sequence sends one row per position and task. For the usual vector
    lengths this is several times faster than one aggregate column per position.
    """
    value = F.when(F.col("_kept"), F.col("_v").cast("double"))
    unrolled = df.select(seq_col, (F.col(mask_col) == 1).alias("_kept"), F.posexplode(vector_col).alias("_pos", "_v"))
    means = unrolled.groupBy(seq_col, "_pos").agg(F.avg(value).alias("_v"))
    # One entry per vector position, so the group is as long as a vector.
    ordered = F.array_sort(F.collect_list(F.struct("_pos", "_v")))
    return means.groupBy(seq_col).agg(F.transform(ordered, lambda e: e["_v"]).alias("embedding"))
