"""Training-order materialisation: token sequences at keyed slots in fixed-stride shards."""

from __future__ import annotations

import base64
import json
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from postloom.llm.common import Sieve, mixed, pick, released
from postloom.session import materialise

# Fixed value: how the byte-level vocabularies split a text into pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ROUNDS = 6
# Text bytes for one shard.
SHARD_OCTETS = 32 << 20
NO_KEY = -(1 << 63)
# Most elements of a permutation.
LIMIT = 1 << 62
FORMAT = "postloom_token_shards"
HEADER = 16  # key (8 bytes), sequence number (4), tokens (4)
# Records that a task reads.
RUN = 1 << 16
SEQUENCES = "slot bigint, shard int, key bigint, seq int, n_tokens int, tokens binary"


@dataclass(frozen=True)
class Permutation:
    """A keyed permutation of ``range(size)``: a balanced Feistel network with cycle-walking."""

    size: int
    key: int

    def __post_init__(self):
        if not 0 < self.size <= LIMIT:
            raise ValueError("a permutation needs 1 to 2 ** 62 elements")

    def __call__(self, values: np.ndarray) -> np.ndarray:
        """The images of uint64 ``values``; images outside the range are walked on until they fall inside."""
        half = max(1, ((self.size - 1).bit_length() + 1) // 2)
        shift, mask = np.uint64(half), np.uint64((1 << half) - 1)
        keys = mixed(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(self.key & (1 << 64) - 1))

        def once(x: np.ndarray) -> np.ndarray:
            left, right = x >> shift, x & mask
            for k in keys:
                left, right = right, left ^ (mixed(right ^ k) >> np.uint64(64 - half) & mask)
            return left << shift | right

        out = once(values.astype(np.uint64))
        outside = np.flatnonzero(out >= self.size)
        while len(outside):
            out[outside] = once(out[outside])
            outside = outside[out[outside] >= self.size]
        return out


class PieceCache(dict):
    """Token bytes of words, remembered for a bounded number of words."""

    def __init__(self, encode, dtype, prefix: str, limit: int = 100_000):
        super().__init__()
        self.encode, self.dtype, self.prefix, self.limit = encode, dtype, prefix, limit

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        self[word] = value = np.array(self.encode(self.prefix + word), dtype=self.dtype).tobytes()
        return value


class Encoder:
    """Whole texts to token bytes with a byte-level vocabulary of ranks.

    Pieces never reach across a space that a non-space follows, so a text is encoded word by
    word and words are remembered. A text with other spacing is encoded as it is.
    """

    SPACED = re.compile(r" \s")

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken

        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.end = max(ranks.values()) + 1
        self.dtype = np.dtype("<u2" if self.end < 1 << 16 else "<u4")
        encode = self.encoding.encode_ordinary
        self.first, self.later = PieceCache(encode, self.dtype, ""), PieceCache(encode, self.dtype, " ")

    def __call__(self, text: str) -> bytes:
        """Token bytes of the text and the end token."""
        end = np.array([self.end], dtype=self.dtype).tobytes()
        if self.SPACED.search(text):
            return np.array(self.encoding.encode_ordinary(text), dtype=self.dtype).tobytes() + end
        first, *later = text.split(" ")
        return b"".join([self.first[first], *map(self.later.__getitem__, later), end])


def read_ranks(path: str) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in Path(path).read_bytes().splitlines() if line)}


@dataclass(frozen=True)
class Layout:
    """What every reader and writer of a shard folder has to know."""

    sequence_tokens: int
    token_bytes: int
    shards: int
    domain: int
    permutation_key: int

    @property
    def stride(self) -> int:
        return HEADER + self.sequence_tokens * self.token_bytes


def placed_sequences(df: DataFrame, ranks: dict[bytes, int], sequence_tokens: int, permutation_key: int, key: str = "doc_id", text: str = "text", shard_octets: int = SHARD_OCTETS) -> tuple[DataFrame, Layout]:
    """Sequences ``(shard, place, key, seq, n_tokens, tokens)`` and the layout of their shards.

    A text is encoded whole, ended by the end token and cut every ``sequence_tokens``
    tokens. Sequence ``seq`` of the document with key ``k`` is element
    ``(k - min) * most + seq`` of the permuted domain, ``most`` being the most sequences
    that the longest text can give (a token is at least a byte). So the place of a
    sequence follows from its own row and few totals: texts are encoded once and nothing
    is numbered before the one shuffle.

    Rows without key, or with a key that others have too, would share elements and so go
    to one shard. They have a part of the domain of their own, where the first element is
    drawn by a hash of key and text; a sieve of the repeated keys tells them (and a few
    others, which does no harm). If the keys' range is too wide for the domain, as that of
    hashes is, all rows are drawn so.
    """
    rows = pick(df, key=key, text=text).select(F.col("key").cast("long").alias("key"), "text")
    octets = F.octet_length("text")
    low, high, longest, total = rows.agg(F.min("key"), F.max("key"), F.max(octets), F.sum(octets.cast("long"))).first()
    low, high = (0, 0) if low is None else (low, high)
    most = -(-((longest or 0) + 1) // sequence_tokens)
    dtype = np.dtype("<u2" if max(ranks.values()) + 1 < 1 << 16 else "<u4")
    repeated = materialise(rows.filter("key IS NOT NULL").groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key"), "repeated-keys")
    rows = Sieve.of(repeated, F.xxhash64("key")).mark(rows, F.xxhash64("key"), "shared")
    span = high - low + 1
    draws = LIMIT // most // 2
    if span > draws:
        span = 0
    layout = Layout(sequence_tokens, dtype.itemsize, max(1, -(-(total or 0) // shard_octets)), (span + draws) * most, permutation_key)
    permutation = Permutation(layout.domain, permutation_key)
    shared = df.sparkSession.sparkContext.broadcast(ranks)
    width, step = -(-layout.domain // layout.shards), sequence_tokens * dtype.itemsize

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in released(batches):
            keys, seqs, elements, tokens = [], [], [], []
            for k, shared_key, value in zip(batch.column("key").to_pylist(), batch.column("shared").to_pylist(), batch.column("text")):
                data = encoder(value.as_py() or "")
                parts = [data[i:i + step] for i in range(0, len(data), step)]
                if span and k is not None and not shared_key:
                    base = (k - low) * most
                else:
                    base = (span + xxhash.xxh3_64_intdigest(data, seed=0 if k is None else k & (1 << 64) - 1) % draws) * most
                keys.extend([k] * len(parts))
                seqs.extend(range(len(parts)))
                elements.extend(range(base, base + len(parts)))
                tokens.extend(parts)
            places = permutation(np.array(elements, dtype=np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array((places // width).astype(np.int32)), pa.array(places), pa.array(keys, pa.int64()), pa.array(seqs, pa.int32()),
                pa.array([len(t) // dtype.itemsize for t in tokens], pa.int32()), pa.array(tokens, pa.binary())],
                ["shard", "place", "key", "seq", "n_tokens", "tokens"])

    return rows.mapInArrow(encode, "shard int, place bigint, key bigint, seq int, n_tokens int, tokens binary"), layout


def write_shard(path: str, layout: Layout, batches: Iterator[pa.RecordBatch]) -> tuple[int, int]:
    """Write a sorted partition as one shard file at ``path``; its number and records, (-1, 0) without rows.

    Records go to a file of this attempt, which takes the shard's name at the end.
    Attempts that are lost leave a file that no manifest names; a repeated one writes
    the same bytes.
    """
    system, folder = fs.FileSystem.from_uri(path)
    system.create_dir(folder, recursive=True)
    shard, records, part, out = -1, 0, f"{folder}/attempt-{uuid.uuid4().hex}", None
    for batch in batches:
        if not batch.num_rows:
            continue
        out = out or system.open_output_stream(part)
        owner = batch.column("shard").to_numpy()
        if shard < 0:
            shard = int(owner[0])
        if (owner != shard).any():
            raise ValueError("a partition must hold one shard")
        table = np.zeros((batch.num_rows, layout.stride), dtype=np.uint8)
        head = np.zeros(batch.num_rows, dtype=[("key", "<i8"), ("seq", "<u4"), ("n", "<u4")])
        head["key"] = batch.column("key").fill_null(NO_KEY).to_numpy()
        head["seq"], head["n"] = batch.column("seq").to_numpy(), batch.column("n_tokens").to_numpy()
        table[:, :HEADER] = head.view(np.uint8).reshape(-1, HEADER)
        for row, tokens in enumerate(batch.column("tokens")):
            data = np.frombuffer(tokens.as_buffer(), dtype=np.uint8)
            table[row, HEADER:HEADER + len(data)] = data
        out.write(table.tobytes())
        records += batch.num_rows
    if out is not None:
        out.close()
        system.move(part, f"{folder}/shard-{shard:06d}.bin")
    return shard, records


def write_manifest(path: str, layout: Layout, written: Iterable[tuple[int, int]]) -> None:
    """The manifest of the shards ``(number, records)``; with it the folder becomes a table."""
    system, folder = fs.FileSystem.from_uri(path)
    system.create_dir(folder, recursive=True)
    first, shards = 0, []
    for shard, records in sorted(x for x in written if x[1]):
        shards.append({"shard": shard, "first_slot": first, "records": records})
        first += records
    with system.open_output_stream(f"{folder}/manifest.json") as out:
        out.write(json.dumps({"layout": vars(layout), "records": first, "shards": shards}).encode())


def read_manifest(path: str) -> dict:
    system, folder = fs.FileSystem.from_uri(path)
    with system.open_input_file(f"{folder}/manifest.json") as file:
        return json.loads(file.read())


def slot_runs(manifest: dict, start: int = 0) -> list[tuple[int, int, int, int]]:
    """``(shard, first_slot, skip, records)`` of the runs of at most RUN records from slot ``start`` on."""
    return [
        (s["shard"], s["first_slot"], skip, min(RUN, s["records"] - skip))
        for s in manifest["shards"] for skip in range(max(0, start - s["first_slot"]), s["records"], RUN)]


def read_run(path: str, layout: Layout, shard: int, first_slot: int, skip: int, records: int) -> Iterator[pa.RecordBatch]:
    """A sequential read of a shard's file: the offset of a record, and a run of records."""
    system, folder = fs.FileSystem.from_uri(path)
    with system.open_input_file(f"{folder}/shard-{shard:06d}.bin") as file:
        file.seek(skip * layout.stride)
        slot, left = first_slot + skip, records
        while left:
            n = min(left, 1 << 13)
            table = np.frombuffer(file.read(n * layout.stride), dtype=np.uint8).reshape(n, layout.stride)
            head = np.ascontiguousarray(table[:, :HEADER]).view([("key", "<i8"), ("seq", "<u4"), ("n", "<u4")]).ravel()
            keys = head["key"]
            tokens = [row[:size].tobytes() for row, size in zip(table[:, HEADER:], (head["n"].astype(np.int64) * layout.token_bytes).tolist())]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(slot, slot + n, dtype=np.int64)), pa.array(np.full(n, shard, np.int32)), pa.array(keys, mask=keys == NO_KEY),
                pa.array(head["seq"].astype(np.int32)), pa.array(head["n"].astype(np.int32)), pa.array(tokens, pa.binary())],
                ["slot", "shard", "key", "seq", "n_tokens", "tokens"])
            slot, left = slot + n, left - n


@dataclass
class ShardWritten(WriterCommitMessage):
    shard: int
    records: int


class ShardWriter(DataSourceArrowWriter):
    """Writes each partition as one shard file; the manifest follows when all are there."""

    def __init__(self, options):
        self.path, self.layout = options["path"], Layout(**json.loads(options["layout"]))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        return ShardWritten(*write_shard(self.path, self.layout, iterator))

    def commit(self, messages) -> None:
        write_manifest(self.path, self.layout, [(m.shard, m.records) for m in messages if m is not None])

    def abort(self, messages) -> None:
        """Without a manifest the folder is no table; its files stay for the caller to look at."""


@dataclass
class SlotRange(InputPartition):
    run: tuple[int, int, int, int] | None


class ShardReader(DataSourceReader):
    """Sequential reads from a slot on, a run of records in each task."""

    def __init__(self, options):
        self.path, start = options["path"], int(options.get("start", "0"))
        manifest = read_manifest(self.path)
        self.layout, self.runs = Layout(**manifest["layout"]), slot_runs(manifest, start)

    def partitions(self):
        return [SlotRange(run) for run in self.runs] or [SlotRange(None)]

    def read(self, partition):
        if partition.run:
            yield from read_run(self.path, self.layout, *partition.run)


class TokenShards(DataSource):
    """The shard files as a data source, for ``spark.read.format`` and ``write.format`` once it is registered.

    Spark plans and commits such a source in Python processes beside the driver, which stay:
    342 MB for a write and a read. ``write_training_order`` and ``read_training_order``
    write and read the same files in tasks alone.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SEQUENCES

    def reader(self, schema):
        return ShardReader(self.options)

    def writer(self, schema, overwrite):
        return ShardWriter(self.options)


def write_training_order(
    df: DataFrame, path: str, ranks: dict[bytes, int], sequence_tokens: int = 256, permutation_key: int = 1, key: str = "doc_id", text: str = "text", shard_octets: int = SHARD_OCTETS
) -> None:
    """Write the sequences of all documents to shard files at ``path``, in permuted order.

    A slot is the rank of a sequence's place, so slots are gapless; shards are ranges of
    places, hence evenly filled. Every record has the same stride, so slot ``s`` is record
    ``s - first_slot`` of its shard. The order depends on the documents and the key alone,
    not on partitions. ``path`` is new, a URI that all executors reach.

    Null and empty texts are one sequence, the end token. Rows that repeat a key, or have
    none, have places drawn by key and text; rows equal in both share places and follow
    each other. An empty table gives a manifest without shards. Keys are integers of any
    range.
    """
    sequences, layout = placed_sequences(df, ranks, sequence_tokens, permutation_key, key, text, shard_octets)
    ordered = sequences.repartitionById(layout.shards, F.col("shard")).sortWithinPartitions("place", "key", "seq", "tokens")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, records = write_shard(path, layout, released(batches))
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([records], pa.int64())], ["shard", "records"])

    # The driver gets two numbers for each shard.
    write_manifest(path, layout, [(r["shard"], r["records"]) for r in ordered.mapInArrow(write, "shard int, records bigint").collect()])


def read_training_order(spark: SparkSession, path: str, start: int = 0) -> DataFrame:
    """``(slot, shard, key, seq, n_tokens, tokens)`` from slot ``start`` on; tokens little-endian."""
    manifest = read_manifest(path)
    layout, runs = Layout(**manifest["layout"]), slot_runs(manifest, start)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column("id").to_pylist():
                yield from read_run(path, layout, *runs[number])

    # A partition for each run.
    return spark.range(0, len(runs), 1, max(1, len(runs))).mapInArrow(read, SEQUENCES)
