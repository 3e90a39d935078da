"""Op 9: token counts with the whole-token shortcut.

Before anything is counted, every string of the vocabulary is merged once: those that come out as one token are
whole tokens. A pre-token that is a whole token counts as one; only the others are merged.

Null texts count as empty and have no tokens. Rows are treated one by one: repeated rows and ids give repeated
results, an empty table gives an empty one. Other columns are passed on, except those named like an output,
which are replaced.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.bpe_model import BpeModel, model_of
from pageloom.llm.shared import Memo, steps, text_of

#: Distinct stretches of text whose counts a Python process remembers (up to twice as many).
REMEMBERED = 100_000
#: Pre-tokens with more letters than this are merged with a heap.
LONG = 200

_COUNTERS: dict[bytes, TokenCounter] = {}


def merged_length(model: BpeModel, letters: str) -> int:
    """Number of tokens of one pre-token, spelled in the vocabulary's alphabet, by merging in order of rank."""
    if not letters:
        return 0
    symbols = [*letters[:-1], letters[-1] + model.suffix]
    ids = [model.ids[x] for x in symbols]
    if len(ids) > LONG:
        return _merged_with_heap(model, ids)
    rank, merged, never = model.rank, model.merged, len(model.rank)
    ranks = [rank.get(pair, never) for pair in zip(ids, ids[1:])]
    while ranks and (least := min(ranks)) < never:
        at = ranks.index(least)
        ids[at] = merged[ids[at], ids.pop(at + 1)]
        del ranks[at]
        if at:
            ranks[at - 1] = rank.get((ids[at - 1], ids[at]), never)
        if at < len(ranks):
            ranks[at] = rank.get((ids[at], ids[at + 1]), never)
    return len(ids)


def _merged_with_heap(model: BpeModel, ids: list[int]) -> int:
    """The same for long input: pairs wait in a heap, positions form a linked list."""
    rank, merged = model.rank, model.merged
    after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
    waiting = [(rank[pair], i) for i, pair in enumerate(zip(ids, ids[1:])) if pair in rank]
    heapq.heapify(waiting)
    left = len(ids)
    while waiting:
        least, i = heapq.heappop(waiting)
        j = after[i]
        if ids[i] < 0 or j < 0 or rank.get((ids[i], ids[j])) != least:
            continue  # one of the two has changed
        ids[i], ids[j] = merged[ids[i], ids[j]], -1
        after[i] = k = after[j]
        if k >= 0:
            before[k] = i
            if (r := rank.get((ids[i], ids[k]))) is not None:
                heapq.heappush(waiting, (r, i))
        if (h := before[i]) >= 0 and (r := rank.get((ids[h], ids[i]))) is not None:
            heapq.heappush(waiting, (r, h))
        left -= 1
    return left


def whole_tokens(model: BpeModel) -> frozenset[str]:
    """Vocabulary strings that are encoded, alone, as one token; each is merged to prove it."""
    suffix = model.suffix
    spelled = (t.removesuffix(suffix) for t in model.ids if not suffix or t.endswith(suffix))
    return frozenset(t for t in spelled if t and merged_length(model, t) == 1)


class TokenCounter:
    def __init__(self, content: bytes, whole: frozenset[str]) -> None:
        self.model = model_of(content)
        self.whole = whole
        self.merged = Memo(lambda letters: merged_length(self.model, letters), REMEMBERED)
        self.chunks = Memo(self._chunk, REMEMBERED)

    def _chunk(self, chunk: str) -> int:
        spell, whole, total = self.model.spell, self.whole, 0
        for piece in self.model.pretokens(chunk):
            letters = spell(piece)
            total += 1 if letters in whole else self.merged[letters]
        return total

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        flat, ends, special = [], [0], []
        for text in texts:
            parts = self.model.with_special(text)
            special.append(sum(isinstance(x, int) for x in parts))
            for part in parts:
                if isinstance(part, str):
                    flat.extend(self.model.chunks(part))
            ends.append(len(flat))
        distinct = pa.array(flat, pa.string()).dictionary_encode()
        counts = np.array([self.chunks[x] for x in distinct.dictionary.to_pylist()], np.int64)
        self.chunks.trim()
        self.merged.trim()
        running = np.concatenate([[0], np.cumsum(counts[distinct.indices.to_numpy()])]).astype(np.int64)
        return np.diff(running[ends]) + np.array(special, np.int64)


def _counter_of(content: bytes, whole: frozenset[str]) -> TokenCounter:
    if content not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[content] = TokenCounter(content, whole)
    return _COUNTERS[content]


def count_tokens(df: DataFrame, tokenizer_file: str, text_col: str = "text", output: str = "n_tokens", keep_text: bool = False) -> DataFrame:
    """Adds the number of tokens of each text; the text column is dropped unless ``keep_text``.

    The tokenizer file is read, and its whole tokens are proven, on the driver; both are sent along. Their size is
    that of the vocabulary.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (output, text_col)]
    rows = df.select(*kept, text_of(text_col).alias(text_col))
    content = Path(tokenizer_file).read_bytes()
    sent = df.sparkSession.sparkContext.broadcast((content, whole_tokens(model_of(content))))
    schema = T.StructType([f for f in rows.schema if keep_text or f.name != text_col]).add(output, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter_of(*sent.value)
        for batch in steps(batches, text_col):
            counts = counter.count(batch.column(text_col).to_pylist())
            columns = [batch.column(n) for n in batch.schema.names if keep_text or n != text_col]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts)], names=schema.names)

    return rows.mapInArrow(run, schema)
