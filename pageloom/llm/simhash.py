"""Op 4: near-duplicate detection with SimHash and deletion-variant signatures.

A fingerprint has 64 bits; two are linked at three or fewer differing bits. Cut into two segments of 32 bits, one
segment then differs by at most one bit. Each fingerprint is indexed under 64 signatures: one segment with one of
its bits wiped out. Linked fingerprints share a signature; those that share one are compared in full.

Signatures shared by more fingerprints than a task should compare are refined: of the other segment, one of two
halves differs by at most one bit, so its 16 bits with one wiped out are added to the signature. 46 bits are then
fixed, so such a group has at most 2^18 different fingerprints, whatever the size of the corpus.

Within a group only the links of a spanning forest are given out. Null texts count as empty; texts without words
have fingerprint zero and are linked like any other. Rows with equal fingerprints are linked, whatever their ids.
The component id is the smallest id reachable; null ids are passed over, and a component of null ids only has a
null id. Repeated rows stay repeated. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from xxhash import xxh64_intdigest

from pageloom.llm.components import components
from pageloom.llm.shared import steps, stored, text_of, unused

SEED = 42
SHINGLE_WORDS = 3
RADIUS = 3
#: Fingerprints of one signature that are compared in one task; above, the signature is refined.
COMPARED = 4096
#: Links that a task joins up before it gives them out.
JOINED = 200_000

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.float64)


def fingerprints(texts: list[bytes], shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """64-bit SimHash of each text over its word shingles, repeats included, as uint64."""
    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = text.lower().split()
        if not words:
            continue
        line = b" ".join(words)
        if len(words) <= shingle_words:
            hashes.append(xxh64_intdigest(line, SEED))
            counts[i] = 1
            continue
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-shingle_words] + 1]).tolist()
        spans = map(slice, starts, ends[shingle_words - 1 :].tolist())
        hashes.extend(map(xxh64_intdigest, map(line.__getitem__, spans), repeat(SEED)))
        counts[i] = len(starts)
    values = np.array(hashes, np.uint64)
    row = np.repeat(np.arange(len(texts)) * 256, counts)
    prints = np.zeros(len(texts), np.uint64)
    for byte in range(8):
        part = (values >> np.uint64(8 * byte)).astype(np.uint8)
        seen = np.bincount(row + part, minlength=256 * len(texts)).reshape(len(texts), 256)
        ones = 2 * (seen @ _BITS) > counts[:, None]
        prints |= np.packbits(ones, axis=1, bitorder="little")[:, 0].astype(np.uint64) << np.uint64(8 * byte)
    return prints


def fingerprint_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, text_key, print`` of every row: a hash of the text, and the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            prints = fingerprints(batch.column("text").to_pylist(), shingle_words)
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(prints.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "print"])

    rows = df.select(*_row_key(id_col, text_col), F.encode(text_of(text_col), "UTF-8").alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_key long, print long")


def _row_key(id_col: str, text_col: str) -> list[Column]:
    return [F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_of(text_col)).alias("text_key")]


def signatures(prints: DataFrame) -> DataFrame:
    """``sign, print``: 64 signatures of each fingerprint, made of segment, bit wiped out and value."""
    at = prints.select("print", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("at"))
    segment = "shiftrightunsigned(print, CAST(at DIV 32 AS INT) * 32) & 4294967295"
    return at.selectExpr(f"shiftleft(CAST(at AS BIGINT), 32) | ({segment} & ~shiftleft(1L, at % 32)) AS sign", "print")


def refined(rows: DataFrame) -> DataFrame:
    """``sign, print``: 32 longer signatures for each row, with a half of the other segment, a bit wiped out."""
    at = rows.select("sign", "print", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("at"))
    other = "CAST(1 - shiftright(sign, 37) AS INT) * 32"
    half = f"shiftrightunsigned(print, {other} + CAST(at DIV 16 AS INT) * 16) & 65535"
    return at.selectExpr(f"shiftleft(sign, 21) | shiftleft(CAST(at AS BIGINT), 16) | ({half} & ~shiftleft(1L, at % 16)) AS sign", "print")


def spanning_links(prints: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links (fingerprint, first of its component) that connect what is linked within a group."""
    links, left = [], prints
    while len(left):
        root, left = int(left[0]), left[1:]
        waiting = [root]
        while waiting and len(left):
            near = np.bitwise_count(left ^ np.uint64(waiting.pop())) <= radius
            if near.any():
                found = left[near].tolist()
                links += zip(found, repeat(root))
                waiting += found
                left = left[~near]
    return links


class _Forest:
    """Joins up links, so that each fingerprint is given out once with the root of its tree."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent, top = self.parent, x
        while (up := parent.get(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent[x]
        return top

    def add(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def links(self) -> pa.RecordBatch:
        nodes = list(self.parent)
        return _output(a=nodes, b=[self.find(x) for x in nodes])


def _output(a, b=None, sign=None) -> pa.RecordBatch:
    """Links, or rows left to be refined (signature and fingerprint)."""
    signed = [None if x is None else pa.array(np.array(x, np.uint64).view(np.int64)) for x in (sign, a, b)]
    return pa.RecordBatch.from_arrays([pa.nulls(len(a), pa.int64()) if x is None else x for x in signed], names=["sign", "a", "b"])


def _link_groups(limit: int | None) -> Callable:
    """A task over rows sorted by signature: links, and the rows of signatures above the limit as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = _Forest()
        signs, prints = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        over = -1  # the last signature found to be above the limit
        for batch in batches:
            signs = np.concatenate([signs, batch.column("sign").to_numpy()])
            prints = np.concatenate([prints, batch.column("print").to_numpy().view(np.uint64)])
            if not len(signs):
                continue
            last = np.searchsorted(signs, signs[-1])
            if limit is not None and (signs[-1] == over or len(signs) - last > limit):
                over, last = signs[-1], len(signs)  # its rows need not wait for the others
            yield from _groups(signs[:last], prints[:last], limit, over, forest)
            signs, prints = signs[last:], prints[last:]
            if len(forest.parent) > JOINED:
                yield forest.links()
                forest = _Forest()
        yield from _groups(signs, prints, limit, over, forest)
        if forest.parent:
            yield forest.links()

    return run


def _groups(signs: np.ndarray, prints: np.ndarray, limit: int | None, over: int, forest: _Forest) -> Iterator[pa.RecordBatch]:
    if not len(signs):
        return
    starts = np.flatnonzero(np.concatenate([[True], signs[1:] != signs[:-1]]))
    sizes = np.diff(np.append(starts, len(signs)))
    large = np.zeros(len(starts), bool) if limit is None else (sizes > limit) | (signs[starts] == over)
    if large.any():
        rows = np.repeat(large, sizes)
        yield _output(a=prints[rows], sign=signs[rows].view(np.uint64))
    two = starts[(sizes == 2) & ~large]
    near = two[np.bitwise_count(prints[two] ^ prints[two + 1]) <= RADIUS]
    for a, b in zip(prints[near].tolist(), prints[near + 1].tolist()):
        forest.add(a, b)
    more = (sizes > 2) & ~large
    for start, size in zip(starts[more].tolist(), sizes[more].tolist()):
        for a, b in spanning_links(prints[start : start + size]):
            forest.add(a, b)


def links(prints: DataFrame, compared: int = COMPARED) -> DataFrame:
    """``a, b``: links that connect all fingerprints (``print``, each once) within the radius of each other."""
    schema = "sign long, a long, b long"
    grouped = signatures(prints).repartition("sign").sortWithinPartitions("sign")
    found = stored(grouped.mapInArrow(_link_groups(compared), schema), "simhash-links")
    large = refined(found.where("sign IS NOT NULL").select("sign", F.col("a").alias("print")))
    more = large.repartition("sign").sortWithinPartitions("sign").mapInArrow(_link_groups(None), schema)
    return found.where("sign IS NULL").select("a", "b").unionByName(more.select("a", "b"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """One row per input row: ``doc_id, text_key, print, root, component_id``.

    ``root`` is the fingerprint that stands for the component.
    """
    rows = stored(fingerprint_rows(df, id_col, text_col, shingle_words), "simhash-prints")
    distinct = stored(rows.groupBy("print").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    trees = components(links(distinct.select("print"))).withColumnRenamed("node", "print")
    rooted = distinct.join(trees, "print", "left").select("print", "first_id", F.coalesce("root", "print").alias("root"))
    rooted = stored(rooted, "simhash-roots")
    smallest = stored(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "simhash-smallest")
    labels = stored(rooted.select("print", "root").join(smallest, "root"), "simhash-components")
    return rows.join(labels, "print").select("doc_id", "text_key", "print", "root", "component_id")


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with all its columns: that of the smallest id."""
    name, repeat = unused(df, "_row"), unused(df, "_repeat")
    row = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    first = near_duplicates(df, id_col, text_col).groupBy("root").agg(F.min(row).alias(name)).select(name)
    key = [c.alias(n) for c, n in zip(_row_key(id_col, text_col), ("doc_id", "text_key"))]
    named = df.withColumn(name, F.struct(F.col(id_col).isNull(), *key).cast(first.schema[name].dataType))
    repeats = Window.partitionBy(name).orderBy(F.col(text_col).asc_nulls_last())
    left = named.join(first, name, "left_semi").withColumn(repeat, F.row_number().over(repeats))
    return left.where(F.col(repeat) == 1).select(*[F.col(f"`{c}`") for c in df.columns])
