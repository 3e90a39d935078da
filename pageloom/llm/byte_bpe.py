"""Op 13: byte-level BPE encoding and decoding with a queue of merge ranks.

The pre-tokens of a batch of texts lie one after the other as a doubly linked list of bytes; lists of different
pre-tokens are not linked. Each adjacent pair whose bytes together are a token waits in the bucket of that token's
rank, by the position of its left part. A bitmap of several levels of 64-bit words tells which buckets hold something,
and find-first-set on one word per level gives the lowest rank. Its pairs are merged from left to right; an entry whose
pair has changed since it was put in is stale and skipped. Merges in one pre-token do not touch another, so the lowest
rank of all is also the next one of each pre-token that has it. A pre-token of n bytes has at most 3n entries, so that
very long ones take time in proportion to their length.

Null texts count as empty: no ids. Rows are treated one by one: repeated rows and ids give repeated results, an empty
table gives an empty one. A text of any length is one row of the result. Columns besides the text are passed on, except
those named like an output, which are replaced.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.shared import steps, text_of

#: Pre-tokens whose ids a Python process remembers (up to twice as many), and the longest that is remembered.
REMEMBERED = 150_000
REMEMBERED_CHARS = 64
#: Bits of a word of the bitmap, as a power of two.
WORD = 6
NEVER = (1 << 31) - 1
#: Buckets up to this size are sorted as Python lists, larger ones in place.
SMALL = 64

#: What ``encode`` can add, and its type.
OUTPUTS = {"ids": "array<int>", "packed": "binary", "decoded": "binary"}


class RankBitmap:
    """A set of ranks that finds its lowest: each bit of a level says whether a word of the level below holds a bit."""

    def __init__(self, size: int) -> None:
        self.levels = []
        while True:
            size = (size >> WORD) + 1
            self.levels.append([0] * size)
            if size == 1:
                break

    def add(self, rank: int) -> None:
        for words in self.levels:
            at, bit = rank >> WORD, 1 << (rank & 63)
            known = words[at]
            words[at] = known | bit
            if known:
                return
            rank = at

    def remove(self, rank: int) -> None:
        for words in self.levels:
            at = rank >> WORD
            words[at] &= ~(1 << (rank & 63))
            if words[at]:
                return
            rank = at

    def first(self) -> int:
        """The lowest rank, or -1."""
        if not self.levels[-1][0]:
            return -1
        at = 0
        for words in reversed(self.levels):
            word = words[at]
            at = at << WORD | (word & -word).bit_length() - 1
        return at


class RankModel:
    """Tokens by rank, and the rank of each pair of tokens that together are a token."""

    def __init__(self, content: bytes) -> None:
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("every byte must be a token")
        self.size = max(self.ranks.values()) + 1
        self.tokens = [b""] * self.size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.vocabulary = pa.array(self.tokens, pa.binary())
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        #: left << 32 | right -> rank
        self.pairs: dict[int, int] = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left << 32 | right] = rank
        single = {int(t): b for b, t in enumerate(self.bytes)}
        self.byte_pairs = np.full((256, 256), NEVER, np.int32)
        for pair, rank in self.pairs.items():
            if (left := single.get(pair >> 32)) is not None and (right := single.get(pair & 0xFFFFFFFF)) is not None:
                self.byte_pairs[left, right] = rank

    def merged(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pre-tokens by merges alone, each as int32 in bytes."""
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        n = len(raw)
        if n == 0:
            return [b""] * len(pieces)
        waits = np.full(n, NEVER, np.int32)
        waits[:-1] = self.byte_pairs[raw[:-1], raw[1:]]
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        last = ends[ends > 0] - 1
        waits[last], after[last] = NEVER, -1
        before[(last + 1)[last + 1 < n]] = -1
        token = array("i", self.bytes[raw].tobytes())
        self._merge(token, array("i", after.tobytes()), array("i", before.tobytes()), array("i", waits.tobytes()))
        ids = np.frombuffer(token, np.int32)
        alive = ids >= 0
        counts = np.concatenate([[0], np.cumsum(alive)])
        cuts, ids = counts[np.concatenate([[0], ends])].tolist(), ids[alive]
        return [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]

    def _merge(self, token: array, after: array, before: array, waits: array) -> None:
        """Merges until no pair is left; ``token`` is -1 where a part has been taken up by the one to its left."""
        buckets, bitmap, pairs = self._queued(waits), RankBitmap(self.size), self.pairs.get
        for rank in buckets:
            bitmap.add(rank)
        while (rank := bitmap.first()) >= 0:
            bitmap.remove(rank)
            bucket = buckets.pop(rank)
            if len(bucket) > SMALL:
                np.frombuffer(bucket, np.int32).sort()
            elif len(bucket) > 1:
                bucket = sorted(bucket)
            lower = False
            for done, at in enumerate(bucket, 1):
                if waits[at] != rank:
                    continue  # stale
                gone = after[at]
                token[at], token[gone] = rank, -1
                waits[at] = waits[gone] = NEVER
                after[at] = right = after[gone]
                if right >= 0:
                    before[right] = at
                    if (found := pairs(rank << 32 | token[right])) is not None:
                        waits[at] = found
                        lower |= found <= rank
                        if found in buckets:
                            buckets[found].append(at)
                        else:
                            buckets[found] = array("i", (at,))
                            bitmap.add(found)
                left = before[at]
                if left >= 0:
                    waits[left] = found = pairs(token[left] << 32 | rank, NEVER)
                    if found != NEVER:
                        lower |= found <= rank
                        if found in buckets:
                            buckets[found].append(left)
                        else:
                            buckets[found] = array("i", (left,))
                            bitmap.add(found)
                if lower:  # only in vocabularies where a token comes before its parts
                    if done < len(bucket):
                        if rank not in buckets:
                            buckets[rank] = array("i")
                            bitmap.add(rank)
                        buckets[rank].extend(array("i", bucket[done:]))
                    break

    @staticmethod
    def _queued(waits: array) -> dict[int, array]:
        """The waiting pairs at the start: rank -> positions in order."""
        ranks = np.frombuffer(waits, np.int32)
        where = np.flatnonzero(ranks != NEVER).astype(np.int32)
        where = where[np.argsort(ranks[where], kind="stable")]
        if len(where) == 0:
            return {}
        begins = np.flatnonzero(np.diff(ranks[where], prepend=-1))
        names = ranks[where[begins]].tolist()
        cuts = [*begins.tolist(), len(where)]
        return {r: array("i", where[a:b].tobytes()) for r, a, b in zip(names, cuts, cuts[1:])}


class ByteEncoder:
    """Whole texts to ids. Each distinct pre-token of a batch of texts is looked up once; unknown ones merge together."""

    def __init__(self, content: bytes, pattern: str) -> None:
        self.model, self.pattern = RankModel(content), regex.compile(pattern)
        self.whole: dict[str, bytes] = {}
        for token, rank in self.model.ranks.items():
            try:
                self.whole[token.decode()] = array("i", (rank,)).tobytes()
            except UnicodeDecodeError:
                continue  # no whole pre-token
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _coded(self, pieces: list[str]) -> list[bytes]:
        whole, new, old = self.whole.get, self.new.get, self.old.get
        coded = [whole(x) or new(x) or old(x) for x in pieces]
        missing = [i for i, c in enumerate(coded) if c is None]
        for i, ids in zip(missing, self.model.merged([pieces[i].encode() for i in missing])):
            coded[i] = ids
            if len(pieces[i]) <= REMEMBERED_CHARS:
                self.new[pieces[i]] = ids
        if len(self.new) > REMEMBERED:
            self.old, self.new = self.new, {}
        return coded

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in one array, and where each text's ids begin (with a last entry for the end)."""
        flat, counts, find = [], [0], self.pattern.findall
        for text in texts:
            flat += find(text)
            counts.append(len(flat))
        distinct = pa.array(flat, pa.string()).dictionary_encode()
        coded = self._coded(distinct.dictionary.to_pylist())
        which = distinct.indices.to_numpy()
        pool = np.frombuffer(b"".join(coded), np.int32)
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        run = sizes[which]
        ends = np.concatenate([[0], np.cumsum(run)])
        shift = (np.cumsum(sizes) - sizes)[which] - ends[:-1]
        return pool[np.repeat(shift, run) + np.arange(ends[-1])], ends[counts]

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> pa.Array:
        """The bytes of each stretch of ids."""
        taken = self.model.vocabulary.take(pa.array(ids))
        if not len(ids):
            return pa.array([b""] * (len(starts) - 1), pa.binary())
        _, offsets, data = taken.buffers()
        cuts = np.frombuffer(offsets, np.int32)[taken.offset + starts]
        return pa.BinaryArray.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(cuts.astype(np.int32).tobytes()), data])


_ENCODERS: dict[tuple[bytes, str], ByteEncoder] = {}


def encoder_of(content: bytes, pattern: str) -> ByteEncoder:
    """The encoder of a rank file's content, built once in each Python process."""
    if (content, pattern) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[content, pattern] = ByteEncoder(content, pattern)
    return _ENCODERS[content, pattern]


def _packed(ids: np.ndarray, starts: np.ndarray) -> pa.Array:
    return pa.BinaryArray.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer((4 * starts).astype(np.int32).tobytes()), pa.py_buffer(ids.astype("<i4").tobytes())])


def encode(df: DataFrame, rank_file: str, pattern: str, text_col: str = "text", outputs: Sequence[str] = ("ids",)) -> DataFrame:
    """Replaces the text by ``outputs``: ``ids``, ``packed`` (ids as little-endian 32-bit integers) and ``decoded``
    (the bytes made from the ids). The rank file is read on the driver and sent along.
    """
    rows = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in outputs and c != text_col], text_of(text_col).alias(text_col))
    file = df.sparkSession.sparkContext.broadcast(Path(rank_file).read_bytes())
    schema = T.StructType([f for f in rows.schema if f.name != text_col])
    for name in outputs:
        schema = schema.add(name, T.DataType.fromDDL(OUTPUTS[name]))
    wanted = list(outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(file.value, pattern)
        for batch in steps(batches, text_col):
            ids, starts = encoder.encode(batch.column(text_col).to_pylist())
            columns = [batch.column(n) for n in batch.schema.names if n != text_col]
            for name in wanted:
                if name == "ids":
                    columns.append(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids)))
                else:
                    columns.append(_packed(ids, starts) if name == "packed" else encoder.decode(ids, starts))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def decode(df: DataFrame, rank_file: str, pattern: str, ids_col: str = "ids", output: str = "decoded") -> DataFrame:
    """Adds the bytes of the ids; null counts as no ids. Null ids and ids that are no token's are left out."""
    known = F.coalesce(F.col(ids_col).cast("array<int>"), F.array().cast("array<int>"))
    rows = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in (ids_col, output)], known.alias(ids_col))
    file = df.sparkSession.sparkContext.broadcast(Path(rank_file).read_bytes())
    schema = T.StructType(list(rows.schema)).add(output, "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder_of(file.value, pattern).model.tokens
        for batch in steps(batches, ids_col):
            texts = [b"".join(tokens[i] for i in ids if i is not None and 0 <= i < len(tokens)) for ids in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=schema.names)

    return rows.mapInArrow(run, schema)
