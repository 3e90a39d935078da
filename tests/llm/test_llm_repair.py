"""Conversation repair against enumeration, the full chart of all spans and splits, and a plain left-to-right search."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest

from pageloom.llm import chat_repair, queries
from pageloom.llm import repair_grammar as grammar

SYMBOLS = "suaxSUAXbd"


def _cost(symbols, audit):
    """Cost of an audit, or None if it gives no allowed roles."""
    turns, total, place = [], 0, 0
    for edit in audit:
        if edit == "I":
            turns.append(("I", None))
            total += 2
            continue
        symbol = symbols[place]
        place += 1
        if edit == "D":
            total += 3
            continue
        if symbol in "bd":
            return None
        turns.append((edit, symbol.lower()))
        total += 2 * (edit == "R") + symbol.isupper()
    odd = len(turns) % 2
    if len(turns) == 1:
        return None
    for k, (edit, symbol) in enumerate(turns):
        wanted = "s" if odd and k == 0 else "ua"[(k - odd) % 2]
        if (edit == "K" and symbol != wanted) or (edit != "K" and wanted == "s"):
            return None
    return total


def _enumerated(symbols):
    found = []
    for edits in itertools.product("KRD", repeat=len(symbols)):
        for gaps in itertools.product(range(3), repeat=len(symbols) + 1):
            audit = "I" * gaps[0] + "".join(e + "I" * g for e, g in zip(edits, gaps[1:]))
            if (cost := _cost(symbols, audit)) is not None:
                found.append((cost, audit))
    return min(found)


def _full_chart(symbols):
    n = len(symbols)
    chart = {(i, i + 1): grammar.row_cell(s) for i, s in enumerate(symbols)}
    for size in range(2, n + 1):
        for i in range(n - size + 1):
            cells = [grammar.joined(chart[i, k], chart[k, i + size]) for k in range(i + 1, i + size)]
            assert all(c == cells[0] for c in cells)  # any split will do
            chart[i, i + size] = cells[0]
    return chart[0, n]


def _searched(symbols):
    """Left to right over (state, cost, audit), with at most two insertions before each row and at the end."""
    moves = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"": (0, "")}

    def put(into, state, entry):
        if state not in into or entry < into[state]:
            into[state] = entry

    def inserted(now):
        for _ in range(2):
            more = dict(now)
            for state, (cost, audit) in now.items():
                for role in "ua":
                    if (state, role) in moves:
                        put(more, moves[state, role], (cost + 2, audit + "I"))
            now = more
        return now

    for symbol in symbols:
        after = {}
        for state, (cost, audit) in inserted(best).items():
            put(after, state, (cost + 3, audit + "D"))
            if symbol in "bd":
                continue
            extra = symbol.isupper()
            for role in "sua":
                if (state, role) not in moves:
                    continue
                if symbol.lower() == role:
                    put(after, moves[state, role], (cost + extra, audit + "K"))
                elif role != "s":
                    put(after, moves[state, role], (cost + 2 + extra, audit + "R"))
        best = after
    return min(e for s, e in inserted(best).items() if s in ("", "a"))


def test_cheapest_edits():
    for n in range(4):
        for symbols in itertools.product(SYMBOLS if n < 3 else "suaUxb", repeat=n):
            text = "".join(symbols)
            assert grammar.cheapest(grammar.span_cell(text)) == _enumerated(text) == _searched(text)


def test_spans_and_splits():
    rnd = random.Random(5)
    for _ in range(40):
        symbols = "".join(rnd.choice(SYMBOLS) for _ in range(rnd.randrange(1, 14)))
        assert _full_chart(symbols) == grammar.span_cell(symbols)
    for n in (100, 1000):
        symbols = "".join(rnd.choice(SYMBOLS) for _ in range(n))
        blocks = [grammar.span_cell(symbols[i : i + 64]) for i in range(0, n, 64)]
        assert grammar.cheapest(grammar.combined(blocks)) == grammar.cheapest(grammar.span_cell(symbols)) == _searched(symbols)


def _repaired(rows):
    """The contract's columns for one conversation's rows (turn, role, text) after damage, in order."""
    if not rows:
        return 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()
    seen, symbols, faults = set(), "", collections.Counter()
    for _, role, text in rows:
        initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        if not solid:
            fault, symbol = "blank", "b"
        elif (role, text) in seen:
            fault, symbol = "duplicate", "d"
        elif solid[-1] not in ".!?":
            fault, symbol = "truncated", initial.upper()
        else:
            fault, symbol = "", initial
        faults[fault] += 1
        symbols += symbol
        seen.add((role, text))
    cost, audit = _searched(symbols)
    lines, left, odd = [], iter(rows), sum(e != "D" for e in audit) % 2
    for edit in audit:
        wanted = ("system" if odd and not lines else ["user", "assistant"][(len(lines) - odd) % 2])
        if edit == "I":
            lines.append(f"{wanted}:")
        else:
            _, role, text = next(left)
            if edit != "D":
                lines.append(f"{role if edit == 'K' else wanted}:{text}")
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def _expected(chats, damage):
    groups = collections.defaultdict(list)
    for conv, turn, role, text in chats:
        rows = groups[conv]
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 19
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        rows += [(turn, role, text)] * (2 if fault == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    return {conv: _repaired(sorted(rows, key=order)) for conv, rows in groups.items()}


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_query(spark, sf_dir):
    chats = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op11_conversation_repair(spark, sf_dir).collect()
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got} == _expected(chats, True)
    assert len(got) == len({c[0] for c in chats})


ROWS = [
    (None, 1, "user", "Hi."), (None, None, "assistant", "Yo."),
    (1, None, None, None), (1, None, "user", "Well?"), (1, 7, "", "No role."), (1, 7, "Tool", "x"),
    (2, 0, "user", "Same."), (2, 0, "user", "Same."), (2, 3, "assistant", "Same."), (2, 9, "user", " \t\x0b"),
    (3, 2, "system", "Be good."), (3, 2, "system", "Be bad."), (3, 3, "assistant", "Is it so"), (3, -3, "user", "é 한 ?"),
    (4, 0, "assistant", "a" * 200_000 + "."), (4, 1, "assistant", "\n"), (5, None, "user", ""),
    (6, 1, "user", "no-break space  "), (6, 2, "assistant", "ends.\n\n"),
]


def test_odd_rows(spark):
    long = [(7, i, ["user", "assistant", "system", "tool"][zlib.crc32(b"%d" % i) % 4], f"Text {i % 150}" + "." * (i % 3)) for i in range(400)]
    rows = ROWS + long
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    clash = chats.selectExpr("*", "'p' AS place", "1 AS symbol", "2 AS edits", "3 AS rows", "4 AS step", "'x' AS line", "5 AS first")
    expected = _expected(rows, False)
    for df in (chats, clash):
        solved, turns = chat_repair.repair(df)
        digest = {r.conv_id: r.sha256 for r in chat_repair.digests(turns).collect()}
        found = solved.select("conv_id", *COLUMNS[:-1]).collect()
        empty = hashlib.sha256(b"").hexdigest()
        assert {r.conv_id: (*(r[c] for c in COLUMNS[:-1]), digest.get(r.conv_id, empty)) for r in found} == expected


def test_text_ids_and_no_rows(spark):
    chats = spark.createDataFrame([("b", 1, "user", "Hi.")], "conv_id string, turn int, role string, text string")
    solved, turns = chat_repair.repair(chats)
    assert [(r.conv_id, r.cost, r.audit) for r in solved.collect()] == [("b", 2, "KI")]
    assert [(r.edit, r.role, r.text) for r in turns.orderBy("place", "step").collect()] == [("K", "user", "Hi."), ("I", "assistant", "")]
    solved, turns = chat_repair.repair(chats.where("false"))
    assert solved.count() == turns.count() == chat_repair.digests(turns).count() == 0


@pytest.mark.parametrize("n", [3000])
def test_long_conversation(spark, n):
    rows = [(1, i, "user" if i % 3 else "assistant", f"{i % 1000}.") for i in range(n)] + [(2, 0, "user", "A.")]
    solved, _ = chat_repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert {r.conv_id: (r.cost, r.audit) for r in solved.collect()} == {c: v[5:7] for c, v in _expected(rows, False).items()}
