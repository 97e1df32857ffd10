"""Repairing a sequence of turns by weighted parsing: a grammar in Chomsky normal form with edits as its terminal rules.

The repaired turns have the form `(system? (user assistant)+)?`. Its places are START, SYSTEM, USER and ASSISTANT (the turn that was
last). A nonterminal [p, q] derives turns that lead from place p to place q, by two kinds of rules:

    [p, q] -> [p, r] [r, q]          for every place r
    [p, q] -> turn                   keep it, give it the role that is due, or delete it (p = q)

and [p, q] may derive nothing by inserting turns that are due; this closure is put around each terminal, so the rules stay in normal form.
A cell of a span holds for each nonterminal the least (cost, audit): the audit names the edits in order. The audit decides the cost, so
of two audits of equal cost none begins with the other, and a least cell is made of least cells only.

Spans are combined bottom-up by their length. [p, q] may be split at any turn of its span, with the same result whichever turn it is; so
one split for each span is enough, in the middle, and a span needs only halves of halves: lengths 1, 2, 4 and so on, with a rest
at the end. Cells of spans that lie side by side in different tasks are combined in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

START, SYSTEM, USER, ASSISTANT = PLACES = range(4)
ENDS = (START, ASSISTANT)
#: The role that may be inserted or given after a place, as (name, place that it leads to).
DUE = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
#: Places from which a turn with this initial may be kept, and where it leads.
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
LEGAL_PAIRS = ("su", "ua", "au")

KEEP, REROLE, DELETE, INSERT = "KRDI"
COSTS = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3
#: Faults of a turn, a letter each; a blank or repeated turn has to go.
SOUND, BLANK, DUPLICATE, TRUNCATED = ".bdt"

#: (cost, audit) of [p, q] at 4 * p + q, None where nothing is derived.
Cells = tuple[tuple[int, str] | None, ...]


def combined(left: Cells, right: Cells) -> Cells:
    """Cells of two neighbouring spans as one."""
    best: list[tuple[int, str] | None] = [None] * 16
    for p in PLACES:
        for r in PLACES:
            a = left[4 * p + r]
            if a is None:
                continue
            for q in PLACES:
                b = right[4 * r + q]
                if b is None:
                    continue
                old, cost = best[4 * p + q], a[0] + b[0]
                if old is None or cost < old[0] or cost == old[0] and a[1] + b[1] < old[1]:
                    best[4 * p + q] = (cost, a[1] + b[1])
    return tuple(best)


def _inserted() -> Cells:
    """Inserting nothing or what is due, until a place comes back."""
    cells: list[tuple[int, str] | None] = [None] * 16
    for p in PLACES:
        q, n = p, 0
        while cells[4 * p + q] is None:
            cells[4 * p + q] = (n * COSTS[INSERT], INSERT * n)
            q, n = DUE[q][1], n + 1
    return tuple(cells)


NOTHING = _inserted()


@lru_cache(None)
def terminal(initial: str, fault: str) -> Cells:
    """Cells of one turn."""
    cells: list[tuple[int, str] | None] = [None] * 16
    more = TRUNCATED_COST if fault == TRUNCATED else 0
    for p in PLACES:
        edits = [(COSTS[DELETE], DELETE, p)]
        if fault not in (BLANK, DUPLICATE):
            edits.append((COSTS[REROLE] + more, REROLE, DUE[p][1]))
            if p in KEPT.get(initial, {}):
                edits.append((COSTS[KEEP] + more, KEEP, KEPT[initial][p]))
        for cost, letter, q in edits:
            old = cells[4 * p + q]
            if old is None or (cost, letter) < old:
                cells[4 * p + q] = (cost, letter)
    return combined(combined(NOTHING, tuple(cells)), NOTHING)


def whole_span(row: list[Cells]) -> Cells:
    """Cells of the span over neighbouring spans, bottom-up by length."""
    while len(row) > 1:
        row = [combined(row[i], row[i + 1]) for i in range(0, len(row) - 1, 2)] + row[len(row) // 2 * 2 :]
    return row[0] if row else NOTHING


def cheapest(whole: Cells) -> tuple[int, str]:
    """Cost and audit of the best repair. No turns at all need none."""
    return min(cell for cell in (whole[4 * START + q] for q in ENDS) if cell is not None)


@lru_cache(1 << 15)
def block_cells(initials: str, faults: str) -> Cells:
    """Cells of some turns in a row; texts of the same form are frequent."""
    return whole_span([terminal(i, f) for i, f in zip(initials, faults, strict=True)])


def illegal_pairs(initials: str) -> int:
    """Neighbours that are no legal pair."""
    return sum(initials[i : i + 2] not in LEGAL_PAIRS for i in range(len(initials) - 1))


class Replay:
    """Applies an audit to the turns it was made for."""

    def __init__(self, audit: str) -> None:
        self._audit, self._at, self._place = audit, 0, START

    def _due(self) -> str:
        name, self._place = DUE[self._place]
        return name

    def inserts(self) -> Iterator[str]:
        """Roles inserted here, in front of the next turn or at the end."""
        while self._audit[self._at : self._at + 1] == INSERT:
            self._at += 1
            yield self._due()

    def edit(self, role: str) -> tuple[str, str | None]:
        """The next turn's edit and its role afterwards (None: deleted)."""
        letter = self._audit[self._at]
        self._at += 1
        if letter == DELETE:
            return letter, None
        if letter == REROLE:
            return letter, self._due()
        self._place = KEPT[role[:1]][self._place]
        return letter, role
