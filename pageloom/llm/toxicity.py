"""Op 5: toxicity by compression distance.

A pair of zstandard dictionaries is trained, one on toxic and one on ordinary text; their size follows the sample. Both
follow a common base trained on ordinary text, so that they differ in what is typical of their class only. A text is
cut into windows of a few words. The gain of a window is its compressed length with the ordinary dictionary less that
with the toxic one. Labelled texts that the dictionaries have not seen calibrate what each gain is worth (the logarithm
of how much more often toxic windows reach it), and a logistic function of a text's windows gives its score; 0.5 is the
threshold.

A second pair holds selected words and is made in rounds. Windows of toxic texts in which a first dictionary, trained on
other toxic texts, finds a gain are searched for the words that make the gain; those that are telling are kept. It finds
a small vocabulary of toxic words, and the trained pair a rich one. The logistic function weighs the gains of both.

All windows of every text are scored. Only the fit is bounded: SAMPLE_ROWS labelled rows of each class, chosen by a hash
of the id, and SAMPLE_WINDOWS windows of each, chosen by a hash of the window. Rows without a label, or with a null
one, take no part in it; of repeated labels the largest counts, of repeated ids the text with the least hash.

Null texts count as empty. A text without windows has the score of no evidence. Repeated rows get equal scores. With no
labelled rows of one class, every score is the share of toxic rows (one half if there are none at all).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from pageloom.llm.shared import steps, text_of

SAMPLE_ROWS = 3000
SAMPLE_WINDOWS = 150
WINDOW_WORDS = 12
LONGEST_WORD = 64
BASE_BYTES, FIRST_BYTES, LIST_BYTES = 64 << 10, 2048, 1536
#: The trained pair has this part of the bytes of the smaller class's sample.
TRAINED_PART = 3
#: Gain of the windows that are searched for the words which make it, and what a word must add.
SEARCHED_GAIN, WORD_GAIN = 2, 2
#: Gains are told apart between these limits; a strong one is at least the last.
LEAST_GAIN, MOST_GAIN, STRONG_GAIN = -6, 14, 4
#: A toxic word is found in this share of toxic texts, and so many times as often as in ordinary ones.
LEAST_SHARE, LEAST_RATIO = 0.02, 20
#: Bytes of a word's beginning that are looked at, and rounds of sharpening.
STEM_BYTES, ROUNDS = 4, 2


def windows(text: bytes) -> list[bytes]:
    """Windows of WINDOW_WORDS words; a word that is too long is cut."""
    words = text.lower().split()
    if any(len(w) > LONGEST_WORD for w in words):
        words = [w[i : i + LONGEST_WORD] for w in words for i in range(0, len(w), LONGEST_WORD)]
    return [b" " + b" ".join(words[i : i + WINDOW_WORDS]) + b" " for i in range(0, len(words), WINDOW_WORDS)]


def train(samples: list[bytes], size: int, times: int = 4) -> bytes:
    """Content of a dictionary trained on the samples; the samples' end if they are too few to train on.

    They are if they have no more than ``times`` its bytes.
    """
    joined = b"".join(samples)
    if len(joined) > times * size and len(samples) >= 16:
        try:
            return zstandard.train_dictionary(size, samples).as_bytes()
        except zstandard.ZstdError:
            pass
    return joined[-size:]


class Compressors:
    """Compressed lengths of windows with either dictionary."""

    def __init__(self, base: bytes, toxic: bytes, ordinary: bytes) -> None:
        self.toxic, self.ordinary = self._made(base + toxic), self._made(base + ordinary)

    @staticmethod
    def _made(content: bytes) -> zstandard.ZstdCompressor:
        content = content if len(content) >= 8 else content.ljust(8)
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=3)
        return zstandard.ZstdCompressor(level=3, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False)

    def gains(self, parts: list[bytes]) -> np.ndarray:
        toxic, ordinary = self.toxic.compress, self.ordinary.compress
        return np.array([len(ordinary(w)) - len(toxic(w)) for w in parts], np.int64)


@dataclass
class Model:
    """Pairs of dictionaries (toxic, ordinary), worth of each gain by pair, and weights.

    There is no pair where nothing could be learned.
    """

    base: bytes
    pairs: list[tuple[bytes, bytes]]
    worth: list[list[float]]
    weights: list[float]

    def scores(self, gains: list[list[np.ndarray]]) -> np.ndarray:
        """Scores of texts, from the gains of their windows with each pair."""
        return _chance(_features_of_pairs(gains, self.worth) @ np.array(self.weights))

    def scorer(self) -> Callable[[list[bytes]], np.ndarray]:
        """A function from texts to scores; it holds the compressors."""
        if not self.pairs:
            return lambda texts: np.full(len(texts), _chance(np.array(self.weights[0])))
        compressors = [Compressors(self.base, *pair) for pair in self.pairs]

        def scores(texts: list[bytes]) -> np.ndarray:
            parts = list(map(windows, texts))
            return self.scores([list(map(c.gains, parts)) for c in compressors])

        return scores


def _features(gains: list[np.ndarray], worth: np.ndarray) -> np.ndarray:
    counts = np.array([len(g) for g in gains])
    row, flat = np.repeat(np.arange(len(gains)), counts), np.concatenate([np.zeros(0, np.int64), *gains])
    value = worth[np.clip(flat, LEAST_GAIN, MOST_GAIN) - LEAST_GAIN]
    total = np.bincount(row, value, minlength=len(gains))
    strong = np.bincount(row, flat >= STRONG_GAIN, minlength=len(gains))
    some = np.maximum(counts, 1)
    return np.stack([np.ones(len(gains)), total / np.sqrt(counts + 1), np.log1p(counts), total / some, np.log1p(strong), np.sqrt(strong / some)], axis=1)


def _features_of_pairs(gains: list[list[np.ndarray]], worth: list[list[float]]) -> np.ndarray:
    """The features of each pair side by side; the constant and the number of windows once."""
    first, *others = (_features(g, np.array(w)) for g, w in zip(gains, worth))
    return np.hstack([first, *(np.delete(x, [0, 2], axis=1) for x in others)])


def _chance(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _words_with_gain(compressors: Compressors, docs: list[list[bytes]]) -> Counter:
    """The words that make the gain of windows, by number of texts. Copies of a window count once."""
    words: Counter = Counter()
    seen: set[bytes] = set()
    for parts in docs:
        new = [w for w in dict.fromkeys(parts) if w not in seen]
        seen.update(new)
        here = set()
        for part, gain in zip(new, compressors.gains(new).tolist()):
            if gain >= SEARCHED_GAIN:
                each = part.split()
                without = [b" " + b" ".join(each[:i] + each[i + 1 :]) + b" " for i in range(len(each))]
                lost = gain - compressors.gains(without)
                here |= {w for w, n in zip(each, lost.tolist()) if n >= WORD_GAIN}
        words.update(here)
    return words


def fit(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> Model:
    """A model from the windows of labelled texts. The last two fifths of each class calibrate it."""
    prior = (len(toxic) + 1) / (len(toxic) + len(ordinary) + 2)
    if len(toxic) < 5 or len(ordinary) < 5:
        return Model(b"", [], [], [float(np.log(prior / (1 - prior)))])
    cut_t, cut_o = 3 * len(toxic) // 5, 3 * len(ordinary) // 5
    halves_t = [toxic[i:cut_t:2] for i in (0, 1)]
    halves_o = [ordinary[i:cut_o:2] for i in (0, 1)]
    flat_t, flat_o = ([[w for d in half for w in d] for half in halves] for halves in (halves_t, halves_o))
    base = train(flat_o[0] + flat_o[1], BASE_BYTES)
    size = max(1, min(map(len, flat_t + flat_o)))
    found, common = Counter(), Counter()
    for mine, other in ((0, 1), (1, 0)):
        first = Compressors(base, train(flat_t[mine], FIRST_BYTES), train(flat_o[mine][:size], FIRST_BYTES))
        found += _words_with_gain(first, halves_t[other])
        common += _words_with_gain(first, halves_o[other])
    words_t, words_o = _new_words(toxic[:cut_t]), _new_words(ordinary[:cut_o])
    stems = _told_apart(set(found), words_t, words_o)
    for _ in range(ROUNDS):  # what was found makes sharper dictionaries, which find more of it
        sharper = Compressors(base, *_dictionaries(stems, common))
        stems = _told_apart(set(_words_with_gain(sharper, toxic[:cut_t])) | set(stems), words_t, words_o)
    pairs = [_dictionaries(stems, common), _trained(toxic[:cut_t], ordinary[:cut_o])]
    return _calibrated(base, pairs, toxic[cut_t:], ordinary[cut_o:])


def _trained(*classes: list[list[bytes]]) -> tuple[bytes, bytes]:
    """A dictionary of each class, trained on all windows. Copies of a window count once."""
    samples = [list(dict.fromkeys(w for d in docs for w in d)) for docs in classes]
    size = max(8, min(sum(map(len, s)) for s in samples) // TRAINED_PART)
    toxic, ordinary = (train(s, size, TRAINED_PART - 1) for s in samples)
    return toxic, ordinary


def _new_words(docs: list[list[bytes]]) -> list[set[bytes]]:
    """The words of each text, without windows that an earlier text has too."""
    seen: set[bytes] = set()
    found = []
    for parts in docs:
        found.append({w for part in parts if part not in seen for w in part.split()})
        seen.update(parts)
    return found


def _told_apart(words: set[bytes], toxic: list[set[bytes]], ordinary: list[set[bytes]]) -> Counter:
    """Words of toxic texts, by number of texts, that begin like one of the given words in a telling way.

    A beginning tells if it is in many toxic texts and in a much smaller share of ordinary ones.
    """
    starts = {w[:n] for w in words for n in range(min(STEM_BYTES, len(w)), len(w) + 1)}
    here, there = (Counter(p for d in docs for p in {w[:n] for w in d if w[:STEM_BYTES] in starts for n in range(STEM_BYTES, len(w) + 1)} & starts) for docs in (toxic, ordinary))
    enough, ratio = max(2, LEAST_SHARE * len(toxic)), LEAST_RATIO * len(toxic) / len(ordinary)
    telling = {p for p, n in here.items() if n >= enough and n > ratio * (there[p] + 1)}
    return Counter(w for d in toxic for w in d if any(w[:n] in telling for n in range(STEM_BYTES, len(w) + 1)))


def _dictionaries(stems: Counter, typical: Counter) -> tuple[bytes, bytes]:
    toxic = _from_words(stems, LIST_BYTES)
    return toxic, _from_words(typical, max(8, len(toxic)))


def _from_words(words: Counter, size: int) -> bytes:
    """A dictionary of words, the most frequent ones last, where they are cheapest to refer to."""
    ordered = sorted(words.items(), key=lambda x: (x[1], x[0]))
    return b"".join(b" " + w for w, _ in ordered)[-size:]


def _calibrated(base: bytes, pairs: list[tuple[bytes, bytes]], toxic_docs: list[list[bytes]], ordinary_docs: list[list[bytes]]) -> Model:
    gains, worth = [], []
    for pair in pairs:
        compressors = Compressors(base, *pair)
        each = [[compressors.gains(d) for d in docs] for docs in (toxic_docs, ordinary_docs)]
        gains.append(each[0] + each[1])
        worth.append(_worth(*each).tolist())
    label = np.array([1.0] * len(toxic_docs) + [0.0] * len(ordinary_docs))
    return Model(base, pairs, worth, _logistic(_features_of_pairs(gains, worth), label).tolist())


def _worth(*classes: list[np.ndarray]) -> np.ndarray:
    """The logarithm of how much more often windows of the first class have each gain."""
    shares = []
    for each in classes:
        flat = np.clip(np.concatenate([np.zeros(0, np.int64), *each]), LEAST_GAIN, MOST_GAIN) - LEAST_GAIN
        seen = 1 + np.bincount(flat, minlength=MOST_GAIN - LEAST_GAIN + 1)
        shares.append(seen / seen.sum())
    return np.log(shares[0] / shares[1])


def _logistic(x: np.ndarray, label: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weights by Newton's method, with a small penalty on all but the constant."""
    weights = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(30):
        chance = _chance(x @ weights)
        slope = x.T @ (chance - label) + penalty @ weights
        curve = (x * (chance * (1 - chance))[:, None]).T @ x + penalty
        step = np.linalg.solve(curve, slope)
        weights = weights - step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text is divisible by 5; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit_on(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model from the labelled rows that are not held out."""
    chosen = labels.where(~held_out(id_col)).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("_label")).where("_label IS NOT NULL AND _id IS NOT NULL")
    order = F.xxhash64("_id"), F.col("_id")
    one, other = (chosen.where(c).orderBy(*order).limit(SAMPLE_ROWS) for c in ("_label = 1", "_label <> 1"))
    sample = F.broadcast(one.unionByName(other))  # at most twice SAMPLE_ROWS rows
    texts = df.select(F.col(id_col).alias("_id"), F.encode(text_of(text_col), "UTF-8").alias("text")).join(sample, "_id")
    texts = texts.groupBy("_id", "_label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))  # combines on the map side

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            parts = [sorted(windows(t), key=xxh64_intdigest)[:SAMPLE_WINDOWS] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_label"), pa.array(parts, pa.list_(pa.binary()))], names=["_id", "_label", "parts"])

    rows = texts.select(F.col("_id").cast("string").alias("_id"), F.col("_label").cast("int").alias("_label"), "text")
    table = rows.mapInArrow(cut, "_id string, _label int, parts array<binary>").toArrow().to_pydict()
    every = sorted(zip(table["_id"], table["parts"], table["_label"]), key=lambda r: (xxh64_intdigest(r[0]), r[1]))
    return fit([p for _, p, y in every if y == 1], [p for _, p, y in every if y != 1])


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in steps(batches, "text"):
            scores = scorer(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores)], names=["doc_id", "held_out", "score"])

    rows = df.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.encode(text_of(text_col), "UTF-8").alias("text"))
    schema = T.StructType(rows.schema.fields[:2]).add("score", "double")
    return rows.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def remove_toxic(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that are not predicted toxic, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in steps(batches, text_col):
            scores = scorer([(t or "").encode() for t in batch.column(text_col).to_pylist()])
            yield batch.filter(pa.array(scores < 0.5))

    return df.mapInArrow(run, df.schema)
