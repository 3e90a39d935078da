"""Op 7: benchmark decontamination with SimHash windows and multi-index Hamming blocks.

Texts become words: lower-cased stretches without white space, without the punctuation around them. Each item of
the benchmark is compared with windows of its own number of words. Items and windows get 64-bit SimHash
fingerprints of their word shingles. The fingerprint is cut into four blocks of 16 bits; at a distance of 19 or
less some block differs by at most four bits. The index lists, for each block value, all items whose block is that
near, so it finds every item within the radius. Candidates are verified exactly: the sum over shingles of the
smaller count, divided by the sum of the larger count, must reach the threshold.

A window that has no shingle in common with any item of its size has similarity zero. Such windows are passed over
before they get a fingerprint (``every_window=True`` turns that off; results are the same).

Items and documents without words match nothing. An item of fewer words than a shingle is one shingle. A document
shorter than an item is one window. Null texts count as empty. Repeated rows of the documents give repeated results;
repeated items count once. Empty tables give empty results.

The benchmark is read in blocks of at most BLOCK_ITEMS items and BLOCK_BYTES bytes (one item at least), which are
sent to all tasks; documents are read once for each block.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from pageloom.llm.shared import Memo, steps, text_of

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RADIUS = 19
BLOCKS, BLOCK_BITS = 4, 16
BLOCK_ITEMS, BLOCK_BYTES = 1000, 2 << 20

_WORD = re.compile(r"[^\W_](?:.*[^\W_])?", re.S)
_MATCH = "item_id long, similarity double, distance int, first_word long, window_words long, n_windows long"

_INDEXES: dict[str, ItemIndex] = {}


def word_of(chunk: str) -> str:
    """The word in a stretch without white space; empty if there is none."""
    found = _WORD.search(chunk)
    return found[0].lower() if found else ""


def words_of(text: str) -> list[str]:
    return [w for w in map(word_of, text.split()) if w]


def shingles_of(words: list[str], size: int = SHINGLE_WORDS) -> list[str]:
    if not words:
        return []
    return [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of shingle counts."""
    common = sum(min(n, b[s]) for s, n in a.items())
    return common / (a.total() + b.total() - common)


def window_prints(hashes: np.ndarray, size: int) -> np.ndarray:
    """SimHash of each run of ``size`` hashes: a bit is set if it is in more than half of them."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32)
    sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])
    ones = 2 * (sums[size:] - sums[:-size]) > size
    return np.packbits(ones, axis=1, bitorder="little").view(np.uint64)[:, 0]


def _hashes(shingles: list[str]) -> np.ndarray:
    return np.array([xxh64_intdigest(s.encode()) for s in shingles], np.uint64)


class ItemIndex:
    """A block of benchmark items: their shingles by number, and their fingerprints by block value."""

    def __init__(self, items: list[tuple[int | None, str]], shingle_words: int, threshold: float, radius: int, every_window: bool) -> None:
        self.size, self.threshold, self.radius, self.every_window = shingle_words, threshold, radius, every_window
        kept = {(i, tuple(w)): None for i, text in items if (w := words_of(text or ""))}
        self.ids = [i for i, _ in kept]
        self.words = [list(w) for _, w in kept]
        self.shingles = [shingles_of(w, shingle_words) for w in self.words]
        self.counts = [Counter(s) for s in self.shingles]
        prints = [window_prints(h, len(h))[0] for h in map(_hashes, self.shingles)]
        self.prints = np.array(prints, np.uint64)
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self._index_blocks()
        self._index_words()

    def _index_blocks(self) -> None:
        reach = self.radius // BLOCKS
        masks = [sum(1 << b for b in bits) for n in range(reach + 1) for bits in combinations(range(BLOCK_BITS), n)]
        masks = np.array(masks, np.int64)
        self.near = []
        for block in range(BLOCKS):
            values = (self.prints >> np.uint64(BLOCK_BITS * block)).astype(np.uint16).astype(np.int64)
            keys = (values[:, None] ^ masks[None, :]).ravel()
            order = np.argsort(keys, kind="stable")
            starts = np.searchsorted(keys[order], np.arange((1 << BLOCK_BITS) + 1))
            self.near.append((starts, (order // len(masks)).astype(np.int32)))

    def _index_words(self) -> None:
        numbers: dict[str, int] = {}
        for words in self.words:
            for word in words:
                numbers.setdefault(word, len(numbers) + 1)
        self.number = Memo(lambda chunk: numbers.get(w, 0) if (w := word_of(chunk)) else -1, 30_000)
        by_size: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
        for item, words in enumerate(self.words):
            size = min(self.size, len(words))
            for code in self._codes(np.array([numbers[w] for w in words], np.int64), size).tolist():
                by_size[size][code].add(item)
        self.sizes = {size: (np.array(sorted(codes), np.uint64), codes) for size, codes in by_size.items()}

    @staticmethod
    def _codes(numbers: np.ndarray, size: int) -> np.ndarray:
        """A code for each run of ``size`` word numbers; equal runs have equal codes."""
        codes = np.zeros(max(0, len(numbers) - size + 1), np.uint64)
        for i in range(size):
            codes = codes * np.uint64(0x9E3779B97F4A7C15) + numbers[i : i + len(codes)].astype(np.uint64)
            codes ^= codes >> np.uint64(29)
        return codes

    def near_items(self, fingerprint: int) -> np.ndarray:
        """Items within the radius of a fingerprint."""
        found = []
        for block, (starts, items) in enumerate(self.near):
            value = fingerprint >> (BLOCK_BITS * block) & 0xFFFF
            found.append(items[starts[value] : starts[value + 1]])
        found = np.unique(np.concatenate(found))
        return found[np.bitwise_count(self.prints[found] ^ np.uint64(fingerprint)) <= self.radius]

    def _windows(self, texts: list[str]) -> Iterator[tuple[int, dict[int, set[int]]]]:
        """For each text that has any, the first words of the windows to compare, by window length."""
        lengths = set(self.lengths.tolist())
        if self.every_window:
            for row, text in enumerate(texts):
                n = len(words_of(text))
                if n:
                    yield row, {w: set(range(max(1, n - w + 1))) for w in lengths}
            return
        flat, ends = [], [0]
        for text in texts:
            flat.extend(text.split())
            ends.append(len(flat))
        distinct = pa.array(flat, pa.string()).dictionary_encode()
        known = np.array([self.number[x] for x in distinct.dictionary.to_pylist()], np.int64)
        self.number.trim()
        numbers = known[distinct.indices.to_numpy()] if flat else np.zeros(0, np.int64)
        is_word = numbers >= 0
        ends = np.concatenate([[0], np.cumsum(is_word)])[ends]
        numbers = numbers[is_word]
        found: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
        for size, (sorted_codes, items_of) in self.sizes.items():
            starts = np.flatnonzero(self._runs(numbers > 0, size))
            codes = np.zeros(len(starts), np.uint64)
            for i in range(size):
                codes = codes * np.uint64(0x9E3779B97F4A7C15) + numbers[starts + i].astype(np.uint64)
                codes ^= codes >> np.uint64(29)
            at = np.minimum(np.searchsorted(sorted_codes, codes), len(sorted_codes) - 1)
            hit = sorted_codes[at] == codes
            starts, codes = starts[hit], codes[hit]
            rows = np.searchsorted(ends, starts, "right") - 1
            inside = starts + size <= ends[rows + 1]
            for start, code, row in zip(starts[inside].tolist(), codes[inside].tolist(), rows[inside].tolist()):
                n, place = int(ends[row + 1] - ends[row]), start - int(ends[row])
                for w in {int(self.lengths[i]) for i in items_of[code]}:
                    first, last = max(0, place - w + size), max(0, min(place, n - w))
                    found[row][w].update(range(min(first, last), last + 1))
        yield from sorted(found.items())

    @staticmethod
    def _runs(flags: np.ndarray, size: int) -> np.ndarray:
        """Where ``size`` flags in a row are set."""
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[size:] - sums[:-size] == size if len(flags) >= size else np.zeros(0, bool)

    def matches(self, texts: list[str]) -> Iterator[tuple]:
        """Row number and, for each item found, id, similarity, distance, first word, window length, windows."""
        for row, windows in self._windows(texts):
            words = words_of(texts[row])
            best: dict[int, list] = {}
            for length, starts in windows.items():
                self._compare(words, min(length, len(words)), length, sorted(starts), best)
            for item in sorted(best):
                yield row, self.ids[item], *best[item]

    def _compare(self, words: list[str], width: int, length: int, starts: list[int], best: dict[int, list]) -> None:
        count = max(1, width - self.size + 1)
        shingles = shingles_of(words[starts[0] : starts[-1] + width], min(self.size, width))
        prints = window_prints(_hashes(shingles), count)
        for start in starts:
            at = start - starts[0]
            fingerprint = int(prints[at])
            items = [i for i in self.near_items(fingerprint).tolist() if self.lengths[i] == length]
            if not items:
                continue
            window = Counter(shingles[at : at + count])
            for item in items:
                close = similarity(window, self.counts[item])
                if close < self.threshold:
                    continue
                distance = int(np.bitwise_count(self.prints[item] ^ np.uint64(fingerprint)))
                known = best.setdefault(item, [-1.0, 0, 0, 0, 0])
                known[4] += 1
                if close > known[0]:
                    known[:4] = close, distance, start, width


def _index_of(key: str, args: tuple) -> ItemIndex:
    if key not in _INDEXES:
        _INDEXES.clear()
        _INDEXES[key] = ItemIndex(*args)
    return _INDEXES[key]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int | None, str]]]:
    rows = benchmark.select(F.col(id_col).cast("long"), text_of(text_col)).distinct()
    block, size = [], 0
    for item_id, text in rows.toLocalIterator():
        if block and (len(block) == BLOCK_ITEMS or size + len(text) > BLOCK_BYTES):
            yield block
            block, size = [], 0
        block.append((item_id, text))
        size += len(text)
    if block:
        yield block


def _arguments(benchmark: DataFrame, item_id: str, item_text: str, shingle_words: int, threshold: float, every_window: bool) -> Iterator[tuple]:
    sc = benchmark.sparkSession.sparkContext
    for block in _blocks(benchmark, item_id, item_text):
        args = block, shingle_words, threshold, RADIUS, every_window
        key = f"{xxh64_intdigest(repr(args).encode()):x}"
        yield key, sc.broadcast(args)


def find_leaks(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    threshold: float = SIMILARITY,
    every_window: bool = False,
) -> DataFrame:
    """A row for each document and item found in it, with the best window and the number of windows."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    schema = T.StructType.fromDDL("doc_id long, " + _MATCH)

    def finder(key: str, sent):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _index_of(key, sent.value)
            for batch in steps(batches, "text"):
                found = list(index.matches(batch.column("text").to_pylist()))
                if found:
                    row, *rest = zip(*found)
                    columns = [batch.column("doc_id").take(pa.array(row)), *rest]
                    kinds = pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=schema.names)

        return run

    parts = [rows.mapInArrow(finder(*x), schema) for x in _arguments(benchmark, item_id, item_text, shingle_words, threshold, every_window)]
    return reduce(DataFrame.unionByName, parts) if parts else df.sparkSession.createDataFrame([], schema)


def remove_leaks(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``df`` in which no item is found, with all their columns."""

    def remover(key: str, sent):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _index_of(key, sent.value)
            for batch in steps(batches, text_col):
                texts = [t or "" for t in batch.column(text_col).to_pylist()]
                keep = np.ones(len(texts), bool)
                keep[[row for row, *_ in index.matches(texts)]] = False
                yield batch.filter(pa.array(keep))

        return run

    for x in _arguments(benchmark, item_id, item_text, SHINGLE_WORDS, SIMILARITY, False):
        df = df.mapInArrow(remover(*x), df.schema)
    return df
