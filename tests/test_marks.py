import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F, types as T

from postloom.session import fresh_path
from postloom.sources.tables import ensure_table
from postloom.streaming.marks import MarkReader, key_ranges, marked_stream, table_files, table_system

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])


def add(spark, path, ids, partitions=2):
    rows = spark.createDataFrame([(f"text {i}", i, 1.5) for i in ids], "text string, id long, extra double")
    rows.repartition(partitions).write.mode("append").parquet(path)


def run(spark, path, target, checkpoint, **options):
    stream = marked_stream(spark, path, SCHEMA, **options)
    stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return sorted(r["id"] for r in spark.read.schema(SCHEMA).parquet(target).collect())


@pytest.fixture
def paths(spark):
    return [fresh_path(spark, n) for n in ("source", "target", "checkpoint")]


def test_each_id_is_read_once_over_runs(spark, paths):
    source, target, checkpoint = paths
    add(spark, source, [-3, 0, 1, 2, 5, 5, None])
    assert run(spark, source, target, checkpoint) == [1, 2, 5, 5]  # above the mark 0; repeats of an id are rows of their own
    assert run(spark, source, target, checkpoint) == [1, 2, 5, 5]
    add(spark, source, [4, 5, 6, 9])  # 4 and 5 come too late for a strict mark
    assert run(spark, source, target, checkpoint) == [1, 2, 5, 5, 6, 9]
    rows = {r["id"]: r["text"] for r in spark.read.parquet(target).collect()}
    assert rows[6] == "text 6" and spark.read.parquet(target).columns == ["id", "text"]


def test_a_killed_run_is_repeated(spark, paths):
    source, target, checkpoint = paths
    ensure_table(spark, target, T.StructType([*SCHEMA.fields, T.StructField("batch", T.LongType())]))
    add(spark, source, range(1, 40))

    def store(dies):
        def write(batch, number):
            if dies == "before":
                raise RuntimeError("lost")
            batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(target)
            if dies == "after":
                raise RuntimeError("lost")
        return write

    def start(dies):
        query = marked_stream(spark, source, SCHEMA).writeStream.foreachBatch(store(dies))
        query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

    with pytest.raises(StreamingQueryException):
        start("before")
    add(spark, source, range(40, 60))  # not in the range of the batch that died
    with pytest.raises(StreamingQueryException):
        start("after")
    start(None)  # repeats the batch that died
    start(None)  # reads on
    # The batch that was written before it died has its number, by which a sink tells the copy.
    rows = spark.read.parquet(target).dropDuplicates(["batch", "id"]).collect()
    assert sorted(r["id"] for r in rows) == list(range(1, 60))


def test_first_mark_and_empty_tables(spark, paths):
    source, target, checkpoint = paths
    ensure_table(spark, source, T.StructType([*SCHEMA.fields, T.StructField("extra", T.DoubleType())]))
    ensure_table(spark, target, SCHEMA)
    assert run(spark, source, target, checkpoint, max_id=10) == []
    add(spark, source, [9, 10, 11])
    assert run(spark, source, target, checkpoint, max_id=10) == [11]


def test_only_row_groups_of_the_range_are_read(spark, paths):
    source = paths[0]
    spark.range(1, 2001).withColumn("text", F.lit("x")).coalesce(1).write.option("parquet.block.row.count.limit", 500).parquet(source)
    add(spark, source, [None], 1)
    reader = MarkReader({"path": source, "max_id": "0"}, SCHEMA)
    assert reader.latestOffset() == {"max_id": 2000}
    groups = [r for f in table_files(*table_system(source)) for r in key_ranges(table_system(source)[0], f.path, "id")]
    wanted = [r for r in groups if r and r[1] > 700 and r[0] <= 900]
    parts = reader.partitions({"max_id": 700}, {"max_id": 900})
    assert len(parts) == len(wanted) and None in groups
    assert sorted(i for p in parts for b in reader.read(p) for i in b.column("id").to_pylist()) == list(range(701, 901))
    assert reader.partitions({"max_id": 900}, {"max_id": 900}) == []


def test_wide_and_wrong_keys(spark, paths):
    source, target, checkpoint = paths
    wide = [2 ** 62, 2 ** 63 - 1]
    add(spark, source, wide)
    assert run(spark, source, target, checkpoint) == wide
    with pytest.raises(ValueError, match="no integer column text"):
        MarkReader({"path": source, "key": "text"}, SCHEMA).latestOffset()
