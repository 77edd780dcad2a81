"""A streaming data source over a keyed parquet table whose offset is the id mark.

The offset log of the query's checkpoint is the committed high-water mark: a micro-batch
holds the rows with ``start < id <= end``, a batch that is repeated after a failure gets the
same range again, and a restarted query goes on behind the last range that it committed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

FORMAT = "postloom_marked_table"
# Rows of a record batch that is handed to Spark.
BATCH_ROWS = 4096


@dataclass
class RowGroup(InputPartition):
    """One row group of a file, and the ids that are read from it: above ``low``, up to ``high``."""

    file: str
    group: int
    low: int
    high: int


def table_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path there."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


def table_files(system: fs.FileSystem, path: str) -> list[fs.FileInfo]:
    """The data files of a table, which is a file or a folder; hidden ones and those in hidden folders are left out."""
    info = system.get_file_info(path)
    if info.type == fs.FileType.File:
        return [info]
    found = system.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))

    def hidden(name: str) -> bool:
        return any(part[:1] in ("_", ".") for part in name[len(path):].split("/"))

    return sorted((f for f in found if f.type == fs.FileType.File and not hidden(f.path)), key=lambda f: f.path)


def key_ranges(system: fs.FileSystem, file: str, key: str) -> list[tuple[int, int] | None]:
    """The smallest and largest key of each row group, None for one without keys.

    They come from the footer's statistics; only a group without them has its key column read.
    """
    ranges: list[tuple[int, int] | None] = []
    with system.open_input_file(file) as opened:
        parquet = pq.ParquetFile(opened)
        place = parquet.schema_arrow.get_field_index(key)
        if place < 0 or not pa.types.is_integer(parquet.schema_arrow.field(place).type):
            raise ValueError(f"{file} has no integer column {key}")
        names = [parquet.schema.column(i).path for i in range(len(parquet.schema))]
        column = names.index(key)
        for group in range(parquet.num_row_groups):
            about = parquet.metadata.row_group(group).column(column).statistics
            if about is not None and about.has_min_max:
                ranges.append((about.min, about.max))
                continue
            ends = pc.min_max(parquet.read_row_group(group, columns=[key]).column(key))
            ranges.append((ends["min"].as_py(), ends["max"].as_py()) if ends["min"].is_valid else None)
    return ranges


class MarkReader(DataSourceStreamReader):
    """Offsets are ``{"max_id": mark}``; a task reads one row group that has ids of the range."""

    def __init__(self, options, schema: T.StructType):
        self.path, self.key, self.first = options["path"], options.get("key", "id"), int(options.get("max_id", "0"))
        self.columns = schema.names
        self.arrow = to_arrow_schema(schema)
        self.footers: dict[tuple[str, int, int], list[tuple[int, int] | None]] = {}

    def _ranges(self) -> dict[str, list[tuple[int, int] | None]]:
        """The key ranges of the table's files; a file's footer is read once as long as it is unchanged."""
        system, folder = table_system(self.path)
        known, now = self.footers, {}
        for f in table_files(system, folder):
            about = (f.path, f.size, f.mtime_ns or 0)
            now[about] = known[about] if about in known else key_ranges(system, f.path, self.key)
        self.footers = now
        return {about[0]: ranges for about, ranges in now.items()}

    def initialOffset(self) -> dict:
        return {"max_id": self.first}

    def latestOffset(self) -> dict:
        tops = [r[1] for ranges in self._ranges().values() for r in ranges if r is not None]
        return {"max_id": max([self.first, *tops])}

    def partitions(self, start: dict, end: dict) -> list[RowGroup]:
        low, high = start["max_id"], end["max_id"]
        if low >= high:
            return []
        return [
            RowGroup(file, group, low, high)
            for file, ranges in self._ranges().items() for group, r in enumerate(ranges) if r is not None and r[1] > low and r[0] <= high]

    def read(self, partition: RowGroup) -> Iterator[pa.RecordBatch]:
        system, _ = table_system(self.path)
        columns = list(dict.fromkeys([*self.columns, self.key]))
        with system.open_input_file(partition.file) as opened:
            for batch in pq.ParquetFile(opened).iter_batches(BATCH_ROWS, row_groups=[partition.group], columns=columns):
                ids = batch.column(batch.schema.get_field_index(self.key))
                inside = batch.filter(pc.and_(pc.greater(ids, partition.low), pc.less_equal(ids, partition.high)))
                if inside.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [inside.column(inside.schema.get_field_index(f.name)).cast(f.type) for f in self.arrow], schema=self.arrow)

    def __getstate__(self):
        """Tasks need no footers."""
        return {**self.__dict__, "footers": {}}


class MarkedTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema):
        return MarkReader(self.options, schema)


def marked_stream(spark: SparkSession, path: str, schema: T.StructType, max_id: int = 0, key: str = "id") -> DataFrame:
    """The rows of a growing parquet table with ids above the mark, each read once.

    The stream form of ``incremental_scan`` with ``watermark_commit``: the first run of a
    checkpoint begins above ``max_id``, later ones behind the mark in its offset log, also
    after a run that died. The strict rule holds here too: a row that arrives with an id at
    or below the mark is not read, nor is one without id. ``schema`` names the columns to
    read, each of which the files have. An empty table, or one without new ids, gives no
    batch.

    Tasks read row groups. Those whose statistics lie outside of the range are not opened,
    so a run over a grown table reads the new files. A run with the trigger ``availableNow``
    is one batch: after a run that died it repeats that run's batch, and the next one reads on. Rows that are added below the end of a
    range before a batch is repeated are read with it: they were not read before.
    """
    spark.dataSource.register(MarkedTable)
    return spark.readStream.format(FORMAT).schema(schema).option("key", key).option("max_id", str(max_id)).load(path)
