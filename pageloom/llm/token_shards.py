"""Op 8: token ids in binary shards, materialised in training order.

Texts are encoded once. Within each input partition their tokens, with an end token after each text, form one stream,
which is cut into sequences of a fixed number of tokens; the last one is filled up with end tokens. These sequences are
stored in compressed blocks with their partition and place. The number of sequences of each partition then gives each
sequence an index in 0..N-1, and a keyed Feistel permutation with cycle-walking maps the index to a global slot.

A shard holds a fixed range of slots. Sequences are dealt out by shard, and each task places those of its shard by slot
and writes them as one file of fixed stride: slot s is at byte (s mod shard_records) * stride of shard s div
shard_records. So training reads shards front to back and resumes at any slot. The same input layout, key and sizes
give the same order. A retried task writes the same bytes; a file appears under its name only when it is complete.

Null texts count as empty: such a document is one end token. Rows are taken as they are, repeated ones too; null ids
are listed as null. An empty table gives no shards. Only the sequence counts come to the driver: 8 bytes for each
partition of the input.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from pageloom.llm.shared import shared_path, steps, stored, text_of

SEQUENCE = 1024
SHARD_RECORDS = 4096
#: Sequences in a stored block, and bytes that a task collects before it deals them out.
BLOCK = 1024
DEALT_BYTES = 12 << 20
ROUNDS = 6
#: Compression of token blocks on their way to the shards.
PACK_LEVEL = 9

_BLOCKS = "part int, first long, n int, valid array<int>, docs array<array<long>>, blob binary"
_DEALT = "shard int, slots array<long>, valid array<int>, docs array<array<long>>, blob binary"
MANIFEST = "slot long, shard int, byte_offset long, n_tokens int, doc_ids array<long>, sha256 string"

_ENCODINGS: dict[bytes, tiktoken.Encoding] = {}


def encoding_of(content: bytes, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file's content, built once in each Python process."""
    if content not in _ENCODINGS:
        _ENCODINGS.clear()
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}
        _ENCODINGS[content] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[content]


class Permutation:
    """A keyed bijection of 0..size-1: a Feistel network over the next power of four, walked until it falls inside."""

    def __init__(self, size: int, key: int) -> None:
        self.size = size
        self.half = max(1, -(-max(1, size - 1).bit_length() // 2))
        self.mask = np.uint64((1 << self.half) - 1)
        self.keys = [np.uint64(xxh64_intdigest(f"{key}:{i}")) for i in range(ROUNDS)]

    def _mixed(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (x + key) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(32))) & self.mask

    def _once(self, x: np.ndarray, keys: list[np.uint64]) -> np.ndarray:
        left, right = x >> np.uint64(self.half), x & self.mask
        for key in keys:
            left, right = right, left ^ self._mixed(right, key)
        return right << np.uint64(self.half) | left  # swapped, so that reversed keys undo it

    def _walked(self, x: np.ndarray, keys: list[np.uint64]) -> np.ndarray:
        x = self._once(np.asarray(x).astype(np.uint64), keys)
        while (outside := x >= self.size).any():
            x[outside] = self._once(x[outside], keys)
        return x.astype(np.int64)

    def slots(self, index: np.ndarray) -> np.ndarray:
        return self._walked(index, self.keys)

    def indexes(self, slots: np.ndarray) -> np.ndarray:
        return self._walked(slots, self.keys[::-1])


def sequences(df: DataFrame, rank_file: str, pattern: str, id_col: str, text_col: str, length: int) -> DataFrame:
    """Blocks of sequences, as a stored table."""
    sent = df.sparkSession.sparkContext.broadcast(Path(rank_file).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoding_of(sent.value, pattern).encode_ordinary, TaskContext.get().partitionId()
        end = len(encoding_of(sent.value, pattern)._mergeable_ranks)
        packer = zstandard.ZstdCompressor(level=PACK_LEVEL)
        tokens, owners, first = np.zeros(0, np.uint16), [], 0  # owners: (where a text begins, its id)

        def block(n: int) -> pa.RecordBatch:
            nonlocal tokens, owners, first
            used = tokens[: n * length]
            valid = [min(length, len(used) - i * length) for i in range(n)]
            starts = [s for s, _ in owners]
            docs = []
            for i in range(n):
                low = max(0, int(np.searchsorted(starts, i * length, "right")) - 1)
                high = int(np.searchsorted(starts, i * length + valid[i], "left"))
                docs.append([d for _, d in owners[low:high]])
            filled = np.concatenate([used, np.full(n * length - len(used), end, np.uint16)])
            row = [[part], [first], [n], [valid], [docs], [packer.compress(filled.tobytes())]]
            tokens, first = tokens[n * length :], first + n
            owners = [(s - n * length, d) for s, d in owners]
            kept = max([i for i, (s, _) in enumerate(owners) if s <= 0], default=0)
            owners = owners[kept:] if len(tokens) else []
            kinds = pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.list_(pa.int64())), pa.binary()
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds)], names=["part", "first", "n", "valid", "docs", "blob"])

        for batch in steps(batches, "text"):
            parts, at = [tokens], len(tokens)
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.array([*encode(text), end], np.uint16)
                owners.append((at, doc_id))
                parts.append(ids)
                at += len(ids)
            tokens = np.concatenate(parts)
            while len(tokens) >= BLOCK * length:
                yield block(BLOCK)
        if len(tokens):
            yield block(-(-len(tokens) // length))

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return stored(rows.mapInArrow(run, _BLOCKS), "token-blocks")


def write_shards(
    df: DataFrame,
    rank_file: str,
    pattern: str,
    key: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = SEQUENCE,
    shard_records: int = SHARD_RECORDS,
) -> tuple[str, DataFrame]:
    """Writes the shards to a new folder below the shared one; gives its path and the manifest of all slots."""
    spark = df.sparkSession
    blocks = sequences(df, rank_file, pattern, id_col, text_col, length)
    counts = dict(blocks.groupBy("part").agg(F.sum("n")).collect())
    before, total = {}, 0
    for part in sorted(counts):
        before[part], total = total, total + counts[part]
    root = shared_path(spark, "shards")
    if not total:
        return root, spark.createDataFrame([], MANIFEST)
    order, stride = Permutation(total, key), 2 * length

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, waiting, size = zstandard.ZstdCompressor(level=PACK_LEVEL), {}, 0
        for batch in batches:
            for row in batch.to_pylist():
                content = zstandard.ZstdDecompressor().decompress(row["blob"])
                slots = order.slots(before[row["part"]] + row["first"] + np.arange(row["n"])).tolist()
                for i, slot in enumerate(slots):
                    record = slot, row["valid"][i], row["docs"][i], content[i * stride : (i + 1) * stride]
                    waiting.setdefault(slot // shard_records, []).append(record)
                size += len(content)
                if size > DEALT_BYTES:
                    yield _dealt(waiting, packer)
                    waiting, size = {}, 0
        if waiting:
            yield _dealt(waiting, packer)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, placed = TaskContext.get().partitionId(), {}
        records = min(shard_records, total - shard * shard_records)
        content = bytearray(records * stride)
        for batch in batches:
            for row in batch.to_pylist():
                data = zstandard.ZstdDecompressor().decompress(row["blob"])
                for i, slot in enumerate(row["slots"]):
                    at = slot - shard * shard_records
                    content[at * stride : (at + 1) * stride] = data[i * stride : (i + 1) * stride]
                    placed[at] = row["valid"][i], row["docs"][i]
        if len(placed) != records:
            raise RuntimeError(f"shard {shard} has {len(placed)} of {records} records")
        _put(root, f"shard-{shard:08d}.bin", content)
        valid, docs = zip(*(placed[at] for at in range(records)))
        digests = [hashlib.sha256(content[i * stride : (i + 1) * stride]).hexdigest() for i in range(records)]
        columns = [shard * shard_records + np.arange(records), np.full(records, shard, np.int32), np.arange(records) * stride]
        arrays = [*map(pa.array, columns), pa.array(valid, pa.int32()), pa.array(docs, pa.list_(pa.int64())), pa.array(digests)]
        yield pa.RecordBatch.from_arrays(arrays, names=["slot", "shard", "byte_offset", "n_tokens", "doc_ids", "sha256"])

    dealt = blocks.mapInArrow(deal, _DEALT).repartitionById(-(-total // shard_records), "shard")
    return root, stored(dealt.mapInArrow(write, MANIFEST), "shard-manifest")


def _dealt(waiting: dict[int, list[tuple]], packer: zstandard.ZstdCompressor) -> pa.RecordBatch:
    columns = [[], [], [], [], []]
    for shard, records in waiting.items():
        slots, valid, docs, content = zip(*records)
        for column, value in zip(columns, (shard, slots, valid, docs, packer.compress(b"".join(content)))):
            column.append(value)
    kinds = pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.list_(pa.int64())), pa.binary()
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["shard", "slots", "valid", "docs", "blob"])


def _put(root: str, name: str, content: bytearray) -> None:
    """Writes a file so that it has its name only when it is complete."""
    system, folder = fs.FileSystem.from_uri(root)
    system.create_dir(folder, recursive=True)
    partial = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(partial) as out:
        out.write(content)
    system.move(partial, f"{folder}/{name}")


def read_slots(spark: SparkSession, root: str, length: int = SEQUENCE, shard_records: int = SHARD_RECORDS, start: int = 0) -> DataFrame:
    """``slot, tokens`` (the bytes of uint16 ids) of all records from slot ``start`` on, read from the shard files."""
    stride = 2 * length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content").to_pylist()):
                slots = shard * shard_records + np.arange(len(content) // stride)
                records = [content[i : i + stride] for i in range(0, len(content), stride)]
                keep = slots >= start
                yield pa.RecordBatch.from_arrays([pa.array(slots[keep]), pa.array([r for r, k in zip(records, keep) if k], pa.binary())], names=["slot", "tokens"])

    files = spark.read.format("binaryFile").load(f"{root}/shard-*.bin")
    numbered = files.select(F.regexp_extract("path", r"shard-(\d+)\.bin$", 1).cast("int").alias("shard"), "content")
    return numbered.where(F.col("shard") >= start // shard_records).mapInArrow(run, "slot long, tokens binary")
