"""The repair grammar of op 11: cells of minimum (cost, audit), combined bottom-up by span length.

A repaired conversation is nothing, or pairs of a user and an assistant turn with perhaps a system turn before them. The
grammar is in Chomsky normal form. A category (p, q) stands for the rows that take a reader of roles from state p to state
q: (p, q) -> (p, r) (r, q) for every state r between, and one row alone by one edit:

- Keep, if its role leads from p to q; Rerole to user or assistant;
- Delete, with p = q;
- Insert spans no row. Its closure, all cheapest insertions from p to q, is applied around each row once; spans put
  together then have insertions everywhere.

Since categories say what may stand at both ends, each split of a span gives the same cells as all splits together: so
spans of 1, 2, 4, 8, … rows are combined, one split for each, and a conversation costs time in proportion to its length.

Of one span and category, two edits of equal cost never have audits of which one begins with the other (they would differ
by insertions, which cost), so the lesser audit stays the lesser one whatever follows, and one entry a cell is enough.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

#: Fixed values of the task: costs of edits, and of an undeleted row that breaks off.
KEEP, REROLE, DELETE, INSERT, BROKEN = 0, 2, 3, 2, 1
#: States: nothing read, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
MOVES = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
FINAL = (START, ASSISTANT)
#: The roles that can be given or put in.
ROLES = {"u": "user", "a": "assistant"}
#: Faults as symbols of rows; other rows are the initial of their role, upper case if they break off.
BLANK, DUPLICATE, OTHER = "b", "d", "x"

Entry = tuple[int, str]
Cell = tuple[Entry | None, ...]


def _categories() -> list[tuple[int, int]]:
    reach = {(p, p) for p in range(4)}
    while len(more := reach | {(p, MOVES[q, x]) for p, q in reach for s, x in MOVES if s == q}) > len(reach):
        reach = more
    return sorted(reach)


CATEGORIES = _categories()
_NUMBER = {c: i for i, c in enumerate(CATEGORIES)}
RULES = [(_NUMBER[p, q], _NUMBER[p, r], _NUMBER[r, q]) for p, q in CATEGORIES for r in range(4) if (p, r) in _NUMBER and (r, q) in _NUMBER]


def joined(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans."""
    cell: list[Entry | None] = [None] * len(CATEGORIES)
    for out, a, b in RULES:
        x, y = left[a], right[b]
        if x is None or y is None:
            continue
        cost, best = x[0] + y[0], cell[out]
        if best is None or cost < best[0] or (cost == best[0] and x[1] + y[1] < best[1]):
            cell[out] = cost, x[1] + y[1]
    return tuple(cell)


def _cell(entries: dict[tuple[int, int], list[Entry]]) -> Cell:
    return tuple(min(entries.get(c, []), default=None) for c in CATEGORIES)


def _inserted() -> Cell:
    """The closure of insertions: the cell of a span without rows."""
    cell = _cell({(p, p): [(0, "")] for p in range(4)} | {(p, q): [(INSERT, "I")] for (p, x), q in MOVES.items() if x in ROLES})
    while (more := joined(cell, cell)) != cell:
        cell = more
    return cell


NOTHING = _inserted()


@lru_cache(maxsize=1000)
def row_cell(symbol: str) -> Cell:
    """The cell of one row, with insertions around it."""
    entries: dict[tuple[int, int], list[Entry]] = {(p, p): [(DELETE, "D")] for p in range(4)}
    if symbol not in (BLANK, DUPLICATE):
        extra = BROKEN if symbol.isupper() else 0
        for (p, x), q in MOVES.items():
            if x == symbol.lower():
                entries.setdefault((p, q), []).append((KEEP + extra, "K"))
            if x in ROLES:
                entries.setdefault((p, q), []).append((REROLE + extra, "R"))
    return joined(joined(NOTHING, _cell(entries)), NOTHING)


def combined(cells: Sequence[Cell]) -> Cell:
    """The cell of successive spans, by spans of 1, 2, 4, … of them."""
    level = list(cells)
    while len(level) > 1:
        pairs = [joined(a, b) for a, b in zip(level[::2], level[1::2])]
        level = pairs + level[len(pairs) * 2 :]
    return level[0] if level else NOTHING


@lru_cache(maxsize=20_000)
def span_cell(symbols: str) -> Cell:
    """The cell of a short span of rows, given by their symbols."""
    return combined([row_cell(s) for s in symbols])


def cheapest(cell: Cell) -> Entry:
    """Cost and audit of a whole conversation."""
    return min(e for q in FINAL if (e := cell[_NUMBER[START, q]]) is not None)


def edits_of(audit: str, rows: int) -> list[list[tuple[str, str | None]]]:
    """For each row the edits up to and with its own, as (initial, role); the last row has those after it, too.

    The role is what the turn gets: null for a kept or deleted row. An odd number of turns begins with a system turn.
    """
    turns = sum(e != "D" for e in audit)
    made, run, turn = [], [], -(turns % 2)
    for edit in audit:
        role = None
        if edit != "D":
            role = None if edit == "K" else ROLES["u" if turn % 2 == 0 else "a"]
            turn += 1
        run.append((edit, role))
        if edit != "I":
            made.append(run)
            run = []
    if run:
        made[-1].extend(run)
    assert len(made) == rows
    return made
