"""Search without a full scan: an inverted-file index whose bounds prove what it leaves out.

Unit vectors are assigned to their nearest centroid. For a query, a list can be left out if
the distance to its centroid less the list's radius is beyond the ``k``-th best row found
so far (triangle inequality); within a list, rows are left out by their own distances to the
centroid. So results are those of ``nearest_postings``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from postloom.operators.search import _CANDIDATES, BLOCK_BYTES, _best, _candidates, _query_blocks, _unit, _unit_rows, ranked
from postloom.session import materialise

# Centroids are fitted on at most this many rows, and there are at most this many of them.
SAMPLE_ROWS, MAX_LISTS, ROUNDS = 20_000, 4_096, 8
# Lists that are searched before bounds are known.
PROBES = 2


@dataclass(frozen=True)
class SearchReport:
    """The neighbours, and the share of all (query, row) pairs in lists that were read for the query."""

    rows: DataFrame
    scored_share: float


def fit_centroids(vectors: DataFrame, lists: int, sample_rows: int = SAMPLE_ROWS, rounds: int = ROUNDS) -> np.ndarray:
    """Means of ``lists`` groups of unit vectors, by a bounded sample: the rows with the smallest hashes of their ids."""
    sample = vectors.select("id", "embedding").orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("embedding").toPandas()
    points = _unit(np.stack([np.asarray(v, dtype=np.float64) for v in sample["embedding"]])) if len(sample) else np.zeros((0, 0))
    points = points[~np.isnan(points).any(axis=1)] if len(points) else points
    centroids = points[:lists].copy()
    for _ in range(rounds if len(centroids) else 0):
        own = np.argmin((centroids ** 2).sum(axis=1) - 2 * points @ centroids.T, axis=1)
        counts = np.bincount(own, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, points)
        centroids[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centroids


def build_index(postings: DataFrame, path: str, lists: int | None = None, sample_rows: int = SAMPLE_ROWS) -> None:
    """Write the lists of ``postings (id, embedding)`` below ``path``, a folder each, and their centroids.

    Every row is assigned; only the centroids come from a sample. A list has as many files
    as tasks met it, so a list that is most of the table is read in parallel. Rows without
    id or vector, and vectors of length 0, whose cosine is undefined, are left out.
    """
    spark = postings.sparkSession
    table = postings.select(F.col("id").cast("long").alias("id"), "embedding").filter("embedding IS NOT NULL AND id IS NOT NULL")
    n = table.count()
    centroids = fit_centroids(table, lists or max(1, min(MAX_LISTS, int(n ** 0.5))), sample_rows)
    shared = spark.sparkContext.broadcast(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        means = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _unit_rows(batch.column("embedding"))
            good = ~np.isnan(unit).any(axis=1)
            batch, unit = batch.filter(pa.array(good)), unit[good]
            own = np.argmin((means ** 2).sum(axis=1) - 2 * unit @ means.T, axis=1) if len(unit) else np.zeros(0, np.int64)
            distance = np.sqrt(((unit - means[own]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(distance), batch.column("id"), batch.column("embedding")], ["list", "distance", "id", "embedding"])

    element = table.schema["embedding"].dataType.simpleString()
    assigned = table.mapInArrow(assign, f"list int, distance double, id bigint, embedding {element}") if len(centroids) else spark.createDataFrame([], f"list int, distance double, id bigint, embedding {element}")
    assigned.sortWithinPartitions("list").write.partitionBy("list").parquet(f"{path}/lists")
    sizes = (spark.read.schema(assigned.schema).parquet(f"{path}/lists") if len(centroids) else assigned).groupBy("list").agg(F.max("distance").alias("radius"), F.count(F.lit(1)).alias("n"))
    means = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centroids)], "list int, centroid array<double>")
    means.join(sizes, "list").write.parquet(f"{path}/centroids")  # one row per list


def _scan_lists(lists: DataFrame, needed: np.ndarray, numbers: np.ndarray, distances: np.ndarray, limit: np.ndarray, ids: np.ndarray, queries: np.ndarray, k: int, digits: int) -> DataFrame:
    """Candidates from the lists that some query needs; a row is scored if its distance allows it for a query."""
    wanted = [int(x) for x in numbers[needed.any(axis=0)]]
    column = {int(x): i for i, x in enumerate(numbers)}
    shared = lists.sparkSession.sparkContext.broadcast((column, needed, distances, limit, ids, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        column, needed, distances, limit, ids, queries = shared.value
        best: dict = {}
        for batch in batches:
            own, away, row_ids = (batch.column(c).to_numpy() for c in ("list", "distance", "id"))
            for number in np.unique(own).tolist():
                c, rows = column[number], np.flatnonzero(own == number)
                asking = np.flatnonzero(needed[:, c])
                near = np.abs(distances[asking, c][:, None] - away[rows]) <= limit[asking][:, None]
                rows = rows[near.any(axis=0)]
                if not len(rows):
                    continue
                scores = np.round(_unit_rows(batch.column("embedding").take(pa.array(rows))) @ queries[asking].T, digits)
                for at, q in enumerate(asking.tolist()):
                    found_ids, found = _best(row_ids[rows], scores[:, at], k)
                    if q in best:
                        found_ids, found = _best(np.concatenate([best[q][0], found_ids]), np.concatenate([best[q][1], found]), k)
                    best[q] = (found_ids, found)
        yield from _candidates(best, ids).to_batches()

    return lists.filter(F.col("list").isin(wanted)).mapInArrow(run, _CANDIDATES)


def search_index(spark: SparkSession, path: str, queries: DataFrame, k: int = 10, digits: int = 6, probes: int = PROBES, block_bytes: int = BLOCK_BYTES) -> SearchReport:
    """``(query_id, rank, id, score)`` of the ``k`` most similar rows of every query, exactly as ``nearest_postings``.

    A block of queries first reads its ``probes`` nearest lists. The ``k``-th best score
    bounds the distance of all better rows; lists beyond it are proved irrelevant, the
    others are read in a second pass. A query with fewer than ``k`` rows so far reads all.
    The centroids, one row per list, and the queries, in bounded blocks, pass through the driver.
    """
    known = spark.read.parquet(f"{path}/centroids").orderBy("list").collect()
    vectors = queries.select(F.col("query_id").cast("long").alias("query_id"), "embedding").filter("embedding IS NOT NULL")
    if not known:
        return SearchReport(spark.createDataFrame([], "query_id long, rank int, id long, score double"), 0.0)
    means, radius, sizes = np.array([r["centroid"] for r in known]), np.array([r["radius"] for r in known]), np.array([r["n"] for r in known], dtype=np.float64)
    numbers = np.array([r["list"] for r in known])
    lists = spark.read.parquet(f"{path}/lists")
    found: DataFrame | None = None
    read = asked = 0.0
    for ids, matrix in _query_blocks(vectors, block_bytes):
        defined = ~np.isnan(matrix).any(axis=1)
        ids, matrix = ids[defined], matrix[defined]
        if not len(ids):
            continue
        distances = np.sqrt(np.maximum(0, 1 + (means ** 2).sum(axis=1) - 2 * matrix @ means.T))
        first = np.zeros(distances.shape, dtype=bool)
        np.put_along_axis(first, np.argsort(distances, axis=1)[:, :probes], True, axis=1)
        everywhere = np.full(len(ids), np.inf)
        near = materialise(_scan_lists(lists, first, numbers, distances, everywhere, ids, matrix, k, digits), "index-probes")
        worst = {r["query_id"]: r["score"] for r in ranked(near, k).filter(F.col("rank") == k).select("query_id", "score").collect()}
        # Rows of at least this score lie within the limit; scores are rounded, so it is a little wider.
        score = np.array([worst.get(i, -np.inf) for i in ids.tolist()])
        limit = np.where(np.isinf(score), np.inf, np.sqrt(np.maximum(0, 2 - 2 * (np.where(np.isinf(score), 0, score) - 10.0 ** -digits))) + 1e-9)
        more = (distances - radius <= limit[:, None]) & ~first
        part = near
        if more.any():
            part = near.unionByName(materialise(_scan_lists(lists, more, numbers, distances, limit, ids, matrix, k, digits), "index-lists"))
        read, asked = read + float(((first | more) * sizes).sum()), asked + len(ids) * sizes.sum()
        found = part if found is None else found.unionByName(part)
    if found is None:
        return SearchReport(spark.createDataFrame([], "query_id long, rank int, id long, score double"), 0.0)
    return SearchReport(ranked(found, k), read / asked)
