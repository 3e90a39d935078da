"""Op 12: periodic runs of words, by a dictionary of basic factors.

Words are the stretches between ASCII white space. A run is a stretch of words with smallest period q (words q apart are
equal) that no neighbouring word extends; those of ``least`` words and ``times`` periods or more are reported.

All texts of a batch are worked on together. For lengths m = 1, 2, 4, … each factor of m words gets a name, equal within
a text for equal factors: the name for 2m is that of its two halves. A factor that does not occur again in its text has
no part in longer repeats and is left out, so that prose is done after a few lengths. The successor of a factor at i is
its next occurrence i + d; those with d up to 2m count. Successive positions with the same d are an arithmetic progression of
occurrences, and propose the period d for the words from the first to the end of the last successor. Proposals are then
extended word by word to both sides, and equal ones are counted once.

This finds every run, and d is its smallest period. Let a run have period q and 2^k be the first power of two that is
not below q. A factor of that length within it holds a whole period, which occurs in the run at multiples of q only; as
2^k + q < 3q, the factor at the run's first word has its successor at distance q. On the other hand a smaller period of a
proposal with three periods would give the factor a nearer successor.

Null texts count as empty: no words, no runs. Rows are treated one by one: repeated rows and ids give repeated results,
an empty table gives an empty one. Columns besides the text are passed on, except those named like an output, which are
replaced. A long text is one step of a task, which takes a few hundred bytes for each of its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.shared import steps, text_of

LEAST, TIMES = 24, 3
#: Words compared at first when a proposal is extended; each further look takes twice as many.
LOOK = 16

RUNS = "array<struct<start:long,length:long,period:long>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _proposals(names: np.ndarray, lo: np.ndarray, hi: np.ndarray, times: int) -> np.ndarray:
    """Rows of (start, stop, period): words that repeat at a distance, at every length of factors.

    ``names`` are words, equal within a text for equal words and different between texts; ``lo`` and ``hi`` bound the
    text of each word.
    """
    n, m, found = len(names), 1, []
    longest = (hi - lo) // times
    at, most = np.arange(n), int(longest.max(initial=0))
    place = np.full(n, -1)
    while len(at) and m < 2 * most:
        order = np.argsort(names, kind="stable")
        sorted_names, sorted_at = names[order], at[order]
        same = sorted_names[1:] == sorted_names[:-1]
        first = sorted_at[:-1][same]
        apart = sorted_at[1:][same] - first
        near = apart <= np.minimum(2 * m, longest[first])
        first, apart = first[near], apart[near]
        if len(first):
            order = np.argsort(first)
            first, apart = first[order], apart[order]
            begins = np.flatnonzero(np.concatenate([[True], (np.diff(first) != 1) | (np.diff(apart) != 0)]))
            ends = np.concatenate([begins[1:], [len(first)]]) - 1
            found.append(np.stack([first[begins], first[ends] + m + apart[begins], apart[begins]], axis=1))
        # The factors that occur again, named in order; two neighbours make a factor of twice the length
        again = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        name = np.cumsum(np.concatenate([[True], ~same]))[again]
        at = sorted_at[again]
        place[:] = -1
        place[at] = name
        at = np.sort(at)
        at = at[at + m < hi[at]]
        right = place[at + m]
        at, right = at[right >= 0], right[right >= 0]
        names = place[at] * (n + 1) + right
        m *= 2
    return np.concatenate(found) if found else np.zeros((0, 3), np.int64)


def _extended(words: np.ndarray, start: int, stop: int, period: int, lo: int, hi: int) -> tuple[int, int]:
    look = LOOK
    while start > lo:
        a = max(lo, start - look)
        differ = np.flatnonzero(words[a:start] != words[a + period : start + period])
        if len(differ):
            start = a + int(differ[-1]) + 1
            break
        start, look = a, 2 * look
    look = LOOK
    while stop < hi:
        b = min(hi, stop + look)
        differ = np.flatnonzero(words[stop:b] != words[stop - period : b - period])
        if len(differ):
            stop += int(differ[0])
            break
        stop, look = b, 2 * look
    return start, stop


def runs_of(words: np.ndarray, sizes: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows of (start, stop, period), by place in ``words``, in order of start and period.

    ``words`` are the codes of the words of several texts, one text after the other, with ``sizes`` words each.
    """
    ends = np.cumsum(sizes)
    hi = np.repeat(ends, sizes)
    lo = np.repeat(ends - sizes, sizes)
    names = np.repeat(np.arange(len(sizes)), sizes) * (int(words.max(initial=0)) + 1) + words
    made = _proposals(names, lo, hi, times)
    if not len(made):
        return made
    start, stop, period = made.T
    left, right = lo[start], hi[start]
    more = ((start > left) & (words[start - 1] == words[start - 1 + period])) | ((stop < right) & (words[np.minimum(stop, len(words) - 1)] == words[stop - period]))
    for i in np.flatnonzero(more):
        made[i, :2] = _extended(words, int(start[i]), int(stop[i]), int(period[i]), int(left[i]), int(right[i]))
    length = made[:, 1] - made[:, 0]
    made = made[length >= np.maximum(least, times * made[:, 2])]
    made = made[np.lexsort((made[:, 2], made[:, 0]))]
    return made[np.concatenate([[True], (np.diff(made, axis=0) != 0).any(axis=1)])] if len(made) else made


def _found(texts: list[str], least: int, times: int) -> tuple[pa.Array, list[int], list[str]]:
    """Runs, number of words and collapsed text of each text."""
    split = [t.encode().split() for t in texts]  # splits at ASCII white space only
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    flat = [w for words in split for w in words]
    codes = pa.array(flat, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    runs = runs_of(codes, sizes, least, times)
    start, stop, period = runs.T
    # A word goes if a run holds it after the run's first period
    steps_ = np.zeros(len(flat) + 1, np.int64)
    np.add.at(steps_, start + period, 1)
    np.add.at(steps_, stop, -1)
    gone = np.cumsum(steps_[:-1]) > 0
    ends = np.concatenate([[0], np.cumsum(sizes)])
    touched = np.concatenate([[0], np.cumsum(gone)])[ends]
    cuts = np.searchsorted(start, ends)
    begin = np.repeat(ends[:-1], np.diff(cuts))
    structs = pa.StructArray.from_arrays([pa.array(x) for x in (start - begin, stop - start, period)], fields=list(_RUN))
    collapsed = []
    for words, a, b, before, after in zip(split, ends, ends[1:], touched, touched[1:]):
        if before != after:
            words = [w for w, g in zip(words, gone[a:b].tolist()) if not g]
        collapsed.append(b" ".join(words).decode())
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), structs), sizes.tolist(), collapsed


def find_runs(df: DataFrame, text_col: str = "text", least: int = LEAST, times: int = TIMES, keep_text: bool = False) -> DataFrame:
    """Adds ``n_words``, ``runs`` (start, length and period in words, by start, then period) and ``collapsed``: the words
    outside of repeats, joined by one space. Of each run the first period stays. The text is dropped unless ``keep_text``.

    Runs have ``least`` words and ``times`` periods at least; three periods are the least that can be asked for.
    """
    if times < 3:
        raise ValueError("runs of fewer than three periods are not found at every length")
    outputs = ("n_words", "runs", "collapsed")
    rows = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in outputs and c != text_col], text_of(text_col).alias(text_col))
    schema = T.StructType([f for f in rows.schema if keep_text or f.name != text_col])
    schema = schema.add("n_words", "long").add("runs", T.DataType.fromDDL(RUNS)).add("collapsed", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text_col):
            runs, sizes, collapsed = _found(batch.column(text_col).to_pylist(), least, times)
            columns = [batch.column(n) for n in batch.schema.names if keep_text or n != text_col]
            columns += [pa.array(sizes, pa.int64()), runs, pa.array(collapsed, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def longest_run(runs: str = "runs"):
    """Of an array of runs, the one with the greatest exact length by period; of equal ones the first."""
    better = lambda best, r: F.when(best.isNull() | (r.length * best.period > best.length * r.period), r).otherwise(best)
    return F.aggregate(F.col(runs), F.lit(None).cast("struct<start:long,length:long,period:long>"), better)
