"""Query vectors and exact nearest postings by cosine."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from postloom import hooks
from postloom.functions.text import e5_prefix
from postloom.operators.embedding import embed_column
from postloom.session import materialise

# Bytes of query vectors that are shipped to the tasks at once.
BLOCK_BYTES = 50 << 20
# Scores that a task holds at once (32 MB of doubles).
SCORE_CELLS = 4_000_000
# Parts into which the candidates of a query are ranked before the last ranking.
SALTS = 32


def query_vector(queries: DataFrame, text_col: str = "text", encoder: hooks.EncoderFactory | None = None, dim: int = 64, **limits) -> DataFrame:
    """Add ``embedding`` of the text prefixed as a query; ``limits`` as in ``embed_column``."""
    prefixed = queries.withColumn("_input", e5_prefix(text_col, "query"))
    return embed_column(prefixed, "_input", "embedding", encoder, dim, **limits).drop("_input")


def query_vector_of(spark: SparkSession, text: str, encoder: hooks.EncoderFactory | None = None, dim: int = 64) -> DataFrame:
    """One row ``(query_id, text, embedding)`` for a single query text."""
    return query_vector(spark.createDataFrame([(0, text)], "query_id long, text string"), "text", encoder, dim)


def _unit_rows(vectors: pa.ListArray) -> np.ndarray:
    """The vectors of a column as rows of unit length; no Python object per value."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths != lengths[0]).any():
        raise ValueError("vectors of one column must have the same dimension")
    return _unit(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lengths), -1))


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))[:, None]
    with np.errstate(invalid="ignore", divide="ignore"):
        return matrix / norms


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best scores, ties by smaller id; undefined scores never qualify."""
    defined = ~np.isnan(scores)
    ids, scores = ids[defined], scores[defined]
    if len(ids) > k:
        bound = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = scores >= bound
        ids, scores = ids[near], scores[near]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _merge_batch(best: dict, query_matrix: np.ndarray, ids: np.ndarray, vectors: pa.ListArray, k: int, digits: int) -> None:
    """Fold a batch of postings into the best ids and scores per query (by matrix row)."""
    rows = max(1, SCORE_CELLS // len(query_matrix))
    for begin in range(0, len(ids), rows):
        part = ids[begin:begin + rows]
        scores = np.round(_unit_rows(vectors.slice(begin, rows)) @ query_matrix.T, digits)
        for column in range(len(query_matrix)):
            found_ids, found = _best(part, scores[:, column], k)
            if column in best:
                found_ids, found = _best(np.concatenate([best[column][0], found_ids]), np.concatenate([best[column][1], found]), k)
            best[column] = (found_ids, found)


def _candidates(best: dict, query_ids: np.ndarray) -> pa.Table:
    parts = [(np.repeat(query_ids[c], len(ids)), ids, scores) for c, (ids, scores) in best.items()]
    columns = [np.concatenate(column) for column in zip(*parts)] if parts else [[], [], []]
    types = (pa.int64(), pa.int64(), pa.float64())
    return pa.table({f.name: pa.array(c, t) for f, c, t in zip(_CANDIDATES.fields, columns, types)})


_CANDIDATES = T.StructType([
    T.StructField("query_id", T.LongType()),
    T.StructField("id", T.LongType()),
    T.StructField("score", T.DoubleType()),
])


def nearest_postings(postings: DataFrame, queries: DataFrame, k: int = 10, digits: int = 6, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` most similar postings of every query, exactly.

    ``postings`` has ``(id, embedding)``, ``queries`` has ``(query_id, embedding)``; scores
    are cosines rounded to ``digits``, equal scores rank by id. Query vectors pass through
    the driver in blocks of at most ``block_bytes``; each block is shipped to the tasks,
    which scan their postings with a matrix product and keep ``k`` rows per query. Only
    these are shuffled, and ranked in parts before the last ranking, so one query with
    very many tasks does not meet in one task whole. With several blocks each is scanned,
    its candidates written and its vectors released before the next one is made.
    """
    vectors = queries.select(F.col("query_id").cast("long").alias("query_id"), "embedding").filter("embedding IS NOT NULL")
    table = postings.select(F.col("id").cast("long").alias("id"), "embedding").filter("embedding IS NOT NULL")
    blocks: list[DataFrame] = []
    pending = None
    for ids, matrix in _query_blocks(vectors, block_bytes):
        if pending is not None:
            blocks.append(_written(*pending))
        pending = _scan_candidates(table, ids, matrix, k, digits)
    if pending is None:
        return queries.sparkSession.createDataFrame([], "query_id long, rank int, id long, score double")
    blocks.append(_written(*pending) if blocks else pending[0])
    return ranked(reduce(DataFrame.unionByName, blocks), k)


def _written(candidates: DataFrame, shared: Broadcast) -> DataFrame:
    """The candidates of a block in a table; its query vectors leave the tasks."""
    table = materialise(candidates, "nearest-candidates")
    shared.destroy()
    return table


def ranked(candidates: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, id, score)`` from candidates of any number of tasks, in salted parts first."""
    best = [F.desc("score"), F.asc("id")]
    salted = candidates.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    part = salted.withColumn("_r", F.row_number().over(Window.partitionBy("query_id", "_salt").orderBy(*best))).filter(F.col("_r") <= k)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*best))
    return part.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def _query_blocks(vectors: DataFrame, block_bytes: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and unit vectors of the queries, in blocks; the plan of the queries runs once."""
    ids: list[int] = []
    rows: list[np.ndarray] = []
    for row in vectors.toLocalIterator():
        vector = np.asarray(row["embedding"], dtype=np.float64)
        if rows and (len(rows) + 1) * vector.nbytes > block_bytes:
            yield np.array(ids), _unit(np.stack(rows))
            ids, rows = [], []
        ids.append(row["query_id"])
        rows.append(vector)
    if rows:
        yield np.array(ids), _unit(np.stack(rows))


def _scan_candidates(table: DataFrame, query_ids: np.ndarray, matrix: np.ndarray, k: int, digits: int) -> tuple[DataFrame, Broadcast]:
    shared = table.sparkSession.sparkContext.broadcast((query_ids, matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries = shared.value
        best: dict = {}
        for batch in batches:
            _merge_batch(best, queries, batch.column("id").to_numpy(), batch.column("embedding"), k, digits)
        yield from _candidates(best, ids).to_batches()

    return table.mapInArrow(run, _CANDIDATES), shared
