import zlib

import pytest
from pyspark.sql import functions as F

from postloom.llm.sharding import number_slots, rendezvous_scores, shard_records, winner

SCHEMA = "doc_id long, text string"


def test_law_and_slots(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    rows = shard_records(docs, [1.0] * 24, grown_weight=1.0, rows_per_block=50).toPandas()
    assert len(rows) == 4000 and rows["shard"].between(0, 23).all()
    # One more shard takes rows only into itself, and about its share of them.
    moved = rows[rows["shard"] != rows["grown_shard"]]
    assert (moved["grown_shard"] == 24).all() and 100 < len(moved) < 230
    for _, shard in rows.groupby("shard"):
        assert sorted(shard["slot"]) == list(range(len(shard)))
    again = shard_records(docs.repartition(7), [1.0] * 24, grown_weight=1.0, rows_per_block=50).toPandas()
    assert rows.sort_values("doc_id").values.tolist() == again.sort_values("doc_id").values.tolist()


def test_weights_share_out_the_keys(spark):
    shards = spark.range(6000).select(winner(rendezvous_scores(F.col("id"), [1.0, 2.0, 3.0])).alias("s")).groupBy("s").count().toPandas().set_index("s")["count"]
    assert 850 < shards[0] < 1150 and 1850 < shards[1] < 2150 and 2850 < shards[2] < 3150
    with pytest.raises(ValueError):
        rendezvous_scores(F.lit(1), [1.0, 0.0])


def test_edges(spark):
    texts = [(1, "é€"), (1, "é€"), (2, None), (None, ""), (None, "z" * 300_000), (3, "")]
    docs = spark.createDataFrame([(i, t, 9, "a") for i, t in texts], SCHEMA + ", shard int, `Slot` string")
    rows = shard_records(docs, [1.0] * 5).collect()
    assert len(rows) == len(texts)
    by_size = sorted((r["size"], r["text_crc32"]) for r in rows)
    assert by_size == sorted((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t in texts)
    assert len({r["shard"] for r in rows if r["doc_id"] == 1}) == 1 and len({r["shard"] for r in rows if r["doc_id"] is None}) == 1
    assert rows[0]["grown_shard"] is None
    assert shard_records(spark.createDataFrame([], SCHEMA), [1.0]).collect() == []
    slots = number_slots(docs.select(F.lit(0).alias("s"), "doc_id"), "s", ["doc_id"], "doc_id", 1, 2)
    assert sorted(r["slot"] for r in slots.collect()) == list(range(6))
