"""Streaming form of the incremental embedding run.

A file stream over the postings replaces the id watermark: its checkpoint records which
files were read, so a posting that arrives late with a low id is not lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from postloom import hooks
from postloom.operators.embedding import assemble_embeddings
from postloom.operators.merge import insert_into
from postloom.operators.stats import MAX_TOKENS
from postloom.plans.embedding import budgeted_postings
from postloom.sources.tables import ensure_table


def posting_stream(spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def insert_stream(
    rows: DataFrame,
    table_path: str,
    checkpoint: str,
    key: str = "id",
    *,
    order_by,
    enrich: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Insert-ignore every micro-batch into a parquet table, then stop when caught up.

    A repeated batch finds its keys in the table and adds nothing, so the result has each
    key once although the sink is called at least once. ``enrich`` computes the expensive
    columns of the rows that are inserted; ``rows`` itself is read several times per batch.
    """
    def store(batch: DataFrame, _: int) -> None:
        ensure_table(batch.sparkSession, table_path, (enrich(batch) if enrich else batch).schema)
        insert_into(table_path, batch, key, order_by=order_by, enrich=enrich)

    return (
        rows.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def state_insert_stream(rows: DataFrame, table_path: str, checkpoint: str, key: str = "id", *, order_by) -> StreamingQuery:
    """Insert-ignore by a keyed state store: the first row of each key goes to the table.

    The state remembers the keys that were seen, so a micro-batch is compared with its own
    keys' state and the stored table is never scanned; a late low id is a new key as any
    other. Of the rows of a micro-batch with one key the first by ``order_by`` counts. State
    and file sink commit with the checkpoint, so each key is written once, also when a
    batch is repeated. The table must be this stream's own and begin empty. Null keys are
    left out.
    """
    names = [order_by] if isinstance(order_by, str) else list(order_by)
    columns = rows.columns

    def first_seen(_, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.exists:
            return
        best = whole = None
        for batch in batches:  # one row is kept, however many the key has
            # Most keys come with one row, which needs no order.
            first = batch if len(batch) == 1 else batch.sort_values(names, kind="stable").iloc[:1]
            whole = list(first.columns) == columns
            best = first if best is None else pd.concat([best, first]).sort_values(names, kind="stable").iloc[:1]
        if best is not None:
            state.update((True,))
            yield best if whole else best[columns]

    inserted = rows.filter(F.col(key).isNotNull()).groupBy(key).applyInPandasWithState(
        first_seen, rows.schema, "seen boolean", "append", GroupStateTimeout.NoTimeout)
    return inserted.writeStream.format("parquet").option("path", table_path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def embedding_stream(
    postings: DataFrame,
    table_path: str,
    checkpoint: str,
    *,
    order_by,
    max_tokens: int = MAX_TOKENS,
    kind: str = "query",
    dim: int = 64,
    encoder: hooks.EncoderFactory | None = None,
) -> StreamingQuery:
    """Format, budget and embed a posting stream and insert it into the embedding table.

    Of the rows of a micro-batch with one id the first by ``order_by`` is inserted.
    """
    def embed(rows: DataFrame) -> DataFrame:
        return assemble_embeddings(budgeted_postings(rows, max_tokens), encoder, kind, dim)

    return insert_stream(postings, table_path, checkpoint, order_by=order_by, enrich=embed)
