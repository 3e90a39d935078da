"""Op 2: BPE encoding and decoding with per-prefix dynamic programming.

Null texts count as empty and give no ids. Rows are treated one by one: repeated rows and ids give repeated
results, an empty table gives an empty one. Columns besides the text are passed on, except those named like an
output, which are replaced.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.bpe_model import PrefixEncoder, model_of
from pageloom.llm.shared import Memo, steps, text_of

#: Distinct stretches of text whose ids a Python process remembers (up to twice as many).
REMEMBERED = 150_000

_ENCODERS: dict[bytes, TextEncoder] = {}


class TextEncoder:
    """Whole texts to ids. Each distinct stretch of a batch of texts is looked up once and remembered."""

    def __init__(self, content: bytes) -> None:
        self.model = model_of(content)
        self.words = PrefixEncoder(self.model)
        self.chunks = Memo(self._chunk, REMEMBERED)

    def _chunk(self, chunk: str) -> bytes:
        special = self.model.special.get(chunk)
        return self.words.encode_chunk(chunk) if special is None else array("i", [special]).tobytes()

    def _cut(self, text: str) -> list[str]:
        parts = self.model.with_special(text)
        if len(parts) == 1 and isinstance(parts[0], str):
            return self.model.chunks(text)
        return [x for p in parts for x in ([self.model.tokens[p]] if isinstance(p, int) else self.model.chunks(p))]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in one array, and where each text's ids begin (with a last entry for the end)."""
        flat, counts = [], [0]
        for text in texts:
            flat.extend(self._cut(text))
            counts.append(len(flat))
        distinct = pa.array(flat, pa.string()).dictionary_encode()
        coded = [self.chunks[x] for x in distinct.dictionary.to_pylist()]
        self.chunks.trim()
        self.words.trim()
        pool = np.frombuffer(b"".join(coded), np.int32)
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        which = distinct.indices.to_numpy()
        run = sizes[which]
        ends = np.concatenate([[0], np.cumsum(run)])
        shift = (np.cumsum(sizes) - sizes)[which] - ends[:-1]
        return pool[np.repeat(shift, run) + np.arange(ends[-1])], ends[counts]


def encoder_of(content: bytes) -> TextEncoder:
    """The encoder of a tokenizer file's content, built once in each Python process."""
    if content not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[content] = TextEncoder(content)
    return _ENCODERS[content]


def _replaced(df: DataFrame, text_col: str, outputs: list[str]) -> DataFrame:
    kept = [F.col(f"`{c}`") for c in df.columns if c not in outputs and c != text_col]
    return df.select(*kept, text_of(text_col).alias(text_col))


def encode(df: DataFrame, tokenizer_file: str, text_col: str = "text", decoded: bool = False, keep_text: bool = False) -> DataFrame:
    """Adds ``ids`` (array of int) and, if asked for, ``decoded``: the text made from those ids.

    The text column is dropped unless ``keep_text``. The tokenizer file is read on the driver and sent along.
    """
    outputs = ["ids", "decoded"] if decoded else ["ids"]
    rows = _replaced(df, text_col, outputs)
    file = df.sparkSession.sparkContext.broadcast(Path(tokenizer_file).read_bytes())
    schema = T.StructType([f for f in rows.schema if keep_text or f.name != text_col])
    schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    if decoded:
        schema = schema.add("decoded", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(file.value)
        for batch in steps(batches, text_col):
            ids, starts = encoder.encode(batch.column(text_col).to_pylist())
            columns = [batch.column(n) for n in batch.schema.names if keep_text or n != text_col]
            columns.append(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids)))
            if decoded:
                decode_ids = encoder.model.decode
                every = ids.tolist()
                columns.append(pa.array([decode_ids(every[a:b]) for a, b in pairwise(starts.tolist())], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def decode(df: DataFrame, tokenizer_file: str, ids_col: str = "ids", output: str = "decoded") -> DataFrame:
    """Adds the text of the ids; null counts as no ids. Ids outside the vocabulary are left out."""
    rows = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in (ids_col, output)], F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias(ids_col))
    file = df.sparkSession.sparkContext.broadcast(Path(tokenizer_file).read_bytes())
    schema = T.StructType(list(rows.schema)).add(output, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder_of(file.value).model
        for batch in steps(batches, ids_col):
            texts = [model.decode([i for i in ids if i is not None]) for ids in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)
