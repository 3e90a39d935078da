"""Op 11: repair of conversations by weighted CYK parsing of intervals (the grammar is in ``repair_grammar``).

Rows are put in the order of conversation, turn (nulls first), role and text; null roles and texts count as one space.
A row's first fault counts: blank (only ASCII white space), duplicate (role and text seen earlier in the conversation),
truncated (its last character that is not white space is none of ``.!?``). Blank and duplicate rows must be deleted. The
cheapest edits give the roles ``(s?(ua)+)?`` by their initials; of equal cost the least audit in ASCII wins.

Order comes from a range shuffle, so that a conversation with a third of all rows is spread over tasks. Its rows are cut
into blocks by their place; cells of blocks are made apart, and then combined for each conversation from costs and
audits alone. Texts are moved twice more only if the repaired turns are asked for. Whether a row is the first of its
kind is looked up by its place, which no two rows share.

Rows that are equal in all columns are rows of their own: all but the first are duplicates. Rows of a null conversation id
form one conversation. Roles that begin with anything but s, u, a (or are empty) can only be changed or deleted. Other
columns are left out. An empty table gives empty results. A conversation's audit is one value.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.repair_grammar import BLANK, DUPLICATE, OTHER, CATEGORIES, cheapest, combined, edits_of, span_cell
from pageloom.llm.shared import stored

#: Rows that are parsed as one block.
BLOCK = 64
#: Characters of role and text by which ranges are dealt out; within a range the whole values count.
RANGE_CHARS = 64
#: ASCII white space, as inside of a pattern's brackets.
SPACE = r"\x20\x09-\x0D"

REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_EDITS = "array<struct<place:long,made:array<struct<edit:string,role:string>>>>"
_CELL = "costs array<long>, audits array<string>"


def truncated(text: Column) -> Column:
    return ~text.rlike(rf"[.!?][{SPACE}]*\z")


def blank(text: Column) -> Column:
    return ~text.rlike(rf"[^{SPACE}]")


def placed(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn, role, text`` with ``place``, by which rows are in order; a stored table."""
    rows = df.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"),
    )
    ranges = ["conv_id", "turn", F.substring("role", 1, RANGE_CHARS), F.substring("text", 1, RANGE_CHARS)]
    ordered = rows.repartitionByRange(*ranges).sortWithinPartitions("conv_id", "turn", "role", "text")
    return stored(ordered.withColumn("place", F.monotonically_increasing_id()), "chat-places")


def _marked(rows: DataFrame) -> DataFrame:
    """Without texts: ``conv_id, turn, place, initial`` and the ``symbol`` that the grammar reads."""
    kinds = rows.select("conv_id", "role", F.sha2("text", 256).alias("sha"), "place")
    firsts = kinds.groupBy("conv_id", "role", "sha").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise(OTHER)
    narrow = rows.select("conv_id", "turn", "place", initial.alias("initial"), known.alias("known"), blank(F.col("text")).alias("blank"), truncated(F.col("text")).alias("cut"))
    symbol = F.when(F.col("blank"), BLANK).when(F.col("first").isNull(), DUPLICATE).when(F.col("cut"), F.upper("known")).otherwise(F.col("known"))
    return narrow.join(firsts, "place", "left").select("conv_id", "turn", "place", "initial", symbol.alias("symbol"))


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cells = [span_cell("".join(s)) for s in batch.column("symbols").to_pylist()]
        costs = pa.array([[None if e is None else e[0] for e in c] for c in cells], pa.list_(pa.int64()))
        audits = pa.array([[None if e is None else e[1] for e in c] for c in cells], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([*batch.columns, costs, audits], names=[*batch.schema.names, "costs", "audits"])


def _solved(blocks: list[dict]) -> dict:
    """The report of one conversation and the edits of its rows, from its blocks in order."""
    cells = [tuple(None if c is None else (c, a) for c, a in zip(b["costs"], b["audits"])) for b in blocks]
    assert all(len(c) == len(CATEGORIES) for c in cells)
    cost, audit = cheapest(combined(cells))
    places, turns, initials, symbols = ([x for b in blocks for x in b[name]] for name in ("places", "turns", "initials", "symbols"))
    known = [t for t in turns if t is not None]
    return {
        "gaps": max(known) - min(known) + 1 - len(set(known)) if known else 0,
        "blank": symbols.count(BLANK),
        "duplicate": symbols.count(DUPLICATE),
        "truncated": sum(map(str.isupper, symbols)),
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in pairwise(initials)),
        "cost": cost,
        "audit": audit,
        "edits": [{"place": p, "made": [{"edit": e, "role": r} for e, r in made]} for p, made in zip(places, edits_of(audit, len(places)))],
    }


def _solutions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string())]))
    longs = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    kinds = {n: pa.int64() for n in longs} | {"audit": pa.string(), "edits": pa.list_(pa.struct([("place", pa.int64()), ("made", made)]))}
    for batch in batches:
        rows = [_solved(blocks) for blocks in batch.column("blocks").to_pylist()]
        columns = [pa.array([r[n] for r in rows], kind) for n, kind in kinds.items()]
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *columns], names=["conv_id", *kinds])


def solve(rows: DataFrame) -> DataFrame:
    """For each conversation of ``placed`` rows: ``conv_id``, its faults, ``cost``, ``audit``, and ``edits`` by place."""
    conv = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}"
    row = F.struct("place", "turn", "initial", "symbol")
    cut = _marked(rows).groupBy("conv_id", F.floor(F.col("place") / BLOCK).alias("block")).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    fields = [F.col(f"rows.{n}").alias(f"{n}s") for n in ("place", "turn", "initial", "symbol")]
    blocks = cut.select("conv_id", "block", *fields)
    cells = blocks.mapInArrow(_cells, f"{conv}, block long, places array<long>, turns array<long>, initials array<string>, symbols array<string>, {_CELL}")
    parts = F.struct("block", "places", "turns", "initials", "symbols", "costs", "audits")
    whole = cells.groupBy("conv_id").agg(F.array_sort(F.collect_list(parts)).alias("blocks"))
    return whole.mapInArrow(_solutions, f"{conv}, {REPORT}, edits {_EDITS}")


def repaired_turns(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """The turns after repair: ``conv_id, place, step, edit, role, text``, in order of place and step.

    Inserted turns have the place of the row before which they are put in, or of the last row, and no text.
    """
    edits = solved.select(F.explode("edits").alias("e")).select("e.place", F.posexplode("e.made").alias("step", "m")).where("m.edit <> 'D'")
    turns = edits.join(rows, "place")
    text = F.when(F.col("m.edit") == "I", F.lit("")).otherwise(F.col("text"))
    return turns.select("conv_id", "place", "step", F.col("m.edit").alias("edit"), F.coalesce("m.role", "role").alias("role"), text.alias("text"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each stretch of rows with one ``conv_id``, read as a stream."""
    now, digest, kind, done = None, None, pa.int64(), []
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for conv, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").to_pylist()):
            if digest is not None and conv == now:
                digest.update(b"\n")
            else:
                if digest is not None:
                    done.append((now, digest.hexdigest()))
                now, digest = conv, hashlib.sha256()
            digest.update(line.encode())
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], kind), pa.array([d for _, d in done], pa.string())], names=["conv_id", "sha256"])
        done = []
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], kind), pa.array([digest.hexdigest()], pa.string())], names=["conv_id", "sha256"])


def digests(turns: DataFrame) -> DataFrame:
    """``conv_id`` and ``sha256`` of its turns, ``role:text`` joined by newlines. Texts pass through, none is collected."""
    lines = turns.select("conv_id", "place", "step", F.concat("role", F.lit(":"), "text").alias("line"))
    ordered = lines.repartition("conv_id").sortWithinPartitions("conv_id", "place", "step").select("conv_id", "line")
    return ordered.mapInArrow(_digests, f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, sha256 string")


def repair(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The report for each conversation, with its ``edits``, and the turns after repair."""
    rows = placed(df, conv_col, turn_col, role_col, text_col)
    solved = stored(solve(rows), "chat-repairs")
    return solved, repaired_turns(rows, solved)
