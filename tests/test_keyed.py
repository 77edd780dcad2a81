import random

import pytest

from postloom.operators import keyed
from postloom.operators.keyed import create_keyed_table, drop_old_versions, read_keyed_table, update_table
from postloom.session import fresh_path

SCHEMA = "id long, seq long, body string"


def rows_of(spark, path):
    return sorted(map(tuple, read_keyed_table(spark, path).collect()), key=str)


@pytest.mark.parametrize("rows_per_bucket", [1_000_000, 3])
def test_updates_keep_the_last_row(spark, monkeypatch, rows_per_bucket):
    monkeypatch.setattr(keyed, "BUCKET_ROWS", rows_per_bucket)
    monkeypatch.setattr(keyed, "LEAST_BUCKETS", 3)
    rng, path, kept = random.Random(5), fresh_path(spark, "keyed"), {}
    for run in range(3):
        rows = [(rng.choice([None, *range(12 + 5 * run)]), seq, f"{run}-{seq}") for seq in range(25)]
        frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
        if run:
            update_table(path, frame, order_by="seq")
        else:
            create_keyed_table(frame, path, order_by="seq")
        kept.update({r[0]: r for r in rows})
        assert rows_of(spark, path) == sorted(kept.values(), key=str)
    update_table(path, frame, order_by="seq")  # the same rows again
    update_table(path, frame.limit(0), order_by="seq")
    assert rows_of(spark, path) == sorted(kept.values(), key=str)
    assert drop_old_versions(spark, path) > 0 and rows_of(spark, path) == sorted(kept.values(), key=str)
    assert drop_old_versions(spark, path) == 0


def test_a_lost_update_is_not_seen(spark, monkeypatch):
    path = fresh_path(spark, "keyed")
    create_keyed_table(spark.createDataFrame([(i, 0, "old") for i in range(30)], SCHEMA), path, order_by="seq", buckets=4)
    opened, before = read_keyed_table(spark, path), rows_of(spark, path)
    new = spark.createDataFrame([(i, 1, "new") for i in range(10, 40)], SCHEMA)
    current = keyed._current(spark, path)
    with monkeypatch.context() as patch:
        patch.setattr(keyed, "_current_path", lambda _: "nowhere://list")
        patch.setattr(keyed, "_current", lambda *_: current)
        with pytest.raises(Exception, match="nowhere"):
            update_table(path, new, order_by="seq")  # its files are written, the list is not
    assert rows_of(spark, path) == before
    update_table(path, new, order_by="seq")
    assert rows_of(spark, path) == sorted([(i, 0, "old") for i in range(10)] + [(i, 1, "new") for i in range(10, 40)], key=str)
    assert sorted(map(tuple, opened.collect()), key=str) == before  # a reader keeps the version that it opened
    assert drop_old_versions(spark, path) >= 4


def test_untouched_buckets_stay(spark):
    path = fresh_path(spark, "keyed")
    create_keyed_table(spark.createDataFrame([(i, 0, "old") for i in range(100)], SCHEMA), path, order_by="seq", buckets=16)
    before = set(read_keyed_table(spark, path).inputFiles())
    update_table(path, spark.createDataFrame([(5, 1, "new")], SCHEMA), order_by="seq")
    after = set(read_keyed_table(spark, path).inputFiles())
    assert len(before - after) == 1 and len(after - before) == 1


def test_wrong_tables(spark):
    rows = spark.createDataFrame([(1, 1, "x")], f"id long, seq long, {keyed.BUCKET} string")
    with pytest.raises(ValueError, match="own"):
        create_keyed_table(rows, fresh_path(spark, "keyed"), order_by="seq")
    with pytest.raises(ValueError, match="buckets"):
        create_keyed_table(rows, fresh_path(spark, "keyed"), order_by="seq", buckets=keyed.MOST_BUCKETS + 1)


def test_a_table_without_rows(spark):
    path, rows = fresh_path(spark, "keyed"), spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], SCHEMA)
    create_keyed_table(rows.limit(0), path, order_by="seq", buckets=4)
    assert read_keyed_table(spark, path, rows.schema).count() == 0
    with pytest.raises(ValueError, match="empty"):
        read_keyed_table(spark, path)
    update_table(path, rows, order_by="seq")
    assert rows_of(spark, path) == [(1, 2, "y")]
