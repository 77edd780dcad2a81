import random

from postloom.session import fresh_path
from postloom.sources.processed import CELL_BITS, commit_processed, merged_intervals, read_processed, unprocessed


def ids_of(mark):
    return sorted(i for r in mark.collect() for i in range(r["lo"], r["hi"] + 1))


def test_every_id_is_read_once(spark):
    rng = random.Random(1)
    path, seen = fresh_path(spark, "processed"), set()
    for run in range(4):
        arrived = [rng.randrange(-3000, 6000) for _ in range(800)] + [10 ** 15 + run, 10 ** 15 + run]
        table = spark.createDataFrame([(i, "x", 1) for i in arrived] + [(None, "no id", 1)], "id long, text string, cell int").repartition(3)
        fresh = unprocessed(table, read_processed(spark, path))
        rows = [r["id"] for r in fresh.collect()]
        assert fresh.columns == table.columns and sorted(rows) == sorted(i for i in arrived if i not in seen)
        commit_processed(spark, path, fresh)
        seen |= set(arrived)
        assert ids_of(read_processed(spark, path)) == sorted(seen)
    before = sorted(map(tuple, read_processed(spark, path).collect()))
    commit_processed(spark, path, spark.createDataFrame([(i,) for i in list(seen)[:50]], "id long"))
    assert sorted(map(tuple, read_processed(spark, path).collect())) == before


def test_intervals_are_merged_within_cells(spark):
    rows = [(0, 1, 3), (0, 4, 6), (0, 2, 2), (0, 9, 9), (1, 1024, 1024), (0, 9, 9)]
    merged = merged_intervals(spark.createDataFrame(rows, "cell long, lo long, hi long"))
    assert sorted(map(tuple, merged.collect())) == [(0, 1, 6), (0, 9, 9), (1, 1024, 1024)]
    path = fresh_path(spark, "processed")
    commit_processed(spark, path, spark.range(5000))
    assert read_processed(spark, path).count() == -(-5000 // (1 << CELL_BITS))


def test_nothing_was_committed(spark):
    path = fresh_path(spark, "processed")
    assert unprocessed(spark.range(3), read_processed(spark, path)).count() == 3
    commit_processed(spark, path, spark.range(0))
    assert unprocessed(spark.range(3), read_processed(spark, path)).count() == 3
