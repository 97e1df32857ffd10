import binascii
import collections
import hashlib
import heapq
import itertools
import random
import re

import pytest

from fixtures import CLASHING, sha
from reportloom.llm import conversation_repair, repair_grammar

NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
FORM = re.compile("(s?(ua)+)?")


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        code = binascii.crc32(name.encode()) % 20
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        out += [(conv, turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return out


def in_order(turns):
    return sorted(turns, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))


def faults_of(turns):
    seen, out = set(), []
    for _, _, role, text in turns:
        bare = text.strip(" \t\n\x0b\f\r")
        out.append("b" if not bare else "d" if (role, text) in seen else "." if bare[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def cheapest_path(turns, faults):
    """Least (cost, audit) over all edits: shortest path over (turns done, place), ties by the audit."""
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, place, lines = heapq.heappop(heap)
        if i == len(turns) and place in (0, 3):
            return cost, audit, list(lines)
        if (i, place) in done:
            continue
        done.add((i, place))
        for name, initial in (("user", "u"), ("assistant", "a")):
            if initial in NEXT[place]:
                heapq.heappush(heap, (cost + 3, audit + "I", i, NEXT[place][initial], (*lines, f"{name}:")))
        if i < len(turns):
            role, text = turns[i][2:]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, place, lines))
            if faults[i] not in "bd":
                more = 3 if faults[i] == "t" else 0
                if role[:1] and role[:1] in NEXT[place]:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, NEXT[place][role[:1]], (*lines, f"{role}:{text}")))
                for name, initial in (("user", "u"), ("assistant", "a")):
                    if initial in NEXT[place]:
                        heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, NEXT[place][initial], (*lines, f"{name}:{text}")))


def plain(rows, turns):
    out = {}
    for conv in {r[0] for r in rows}:
        own = in_order(r for r in turns if r[0] == conv)
        faults = faults_of(own)
        known = [r[1] for r in own if r[1] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        initials = [r[2][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, audit, lines = cheapest_path(own, faults)
        out[conv] = (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, sha("\n".join(lines)))
    return out


def rows_of(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(n), None]:
        for turn in range(rng.choice([1, 2, 5, 8, 13])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool", "User"]) if rng.random() < 0.4 else ("user", "assistant")[turn % 2]
            text = rng.choice(["Yes.", "No!", "why", "open\n", " \t", "", None, "Done. \n", "Ünd?", f"t{turn}.", f"t{turn}"])
            rows.append((conv, rng.choice([turn, turn, turn, None, turn * 3, 2, -turn]), role, text))
    return rows + [rows[0], rows[0], (n + 1, None, None, None), (n + 2, 5, "user", "x" * 200_000)]


def table(spark, rows, clashing=False):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    if clashing:
        df = df.withColumns({name: conversation_repair.F.lit(i) for i, name in enumerate((*CLASHING, "hash", "kind", "seq", "n", "fault", "damage", "copy"))})
    return df.repartition(3)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_shortest_paths(spark, seed):
    rows = rows_of(seed)
    turns = plain_damage(rows)
    got = conversation_repair.damaged_and_repaired(table(spark, rows, clashing=True))
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"] * 2
    found = got.collect()
    assert {r[0]: tuple(r)[1:] for r in found} == plain(rows, turns)
    assert len(found) == len({r[0] for r in rows})
    assert any("I" in r.audit for r in found) and any("R" in r.audit for r in found)


def test_small_blocks_give_the_same(spark, monkeypatch):
    """Conversations cut into spans of two turns, over many partitions."""
    rows = rows_of(7, 10) + [(99, i, ("user", "assistant", "assistant")[i % 3], f"t{i // 2}" + "." * (i % 4)) for i in range(400)]
    rows += [(98, 1, "user", "same.")] * 700
    monkeypatch.setattr(conversation_repair.parsed_blocks, "__defaults__", (2,))
    got = conversation_repair.damaged_and_repaired(table(spark, rows))
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == plain(rows, plain_damage(rows))


def test_repaired_turns(spark):
    rows = rows_of(4, 30)
    got = collections.defaultdict(list)
    for r in conversation_repair.repaired_turns(table(spark, rows)).collect():
        got[r.conv_id].append(r)
    plain_rows = [(c, t, " " if role is None else role, " " if text is None else text) for c, t, role, text in rows]
    for conv, own in got.items():
        kept = sorted((r for r in own if r.edit != "D"), key=lambda r: r.place)
        assert [r.place for r in kept] == list(range(len(kept)))
        assert FORM.fullmatch("".join(r.role[0] for r in kept))
        turns = in_order(r for r in plain_rows if r[0] == conv)
        assert [f"{r.role}:{r.text}" for r in kept] == cheapest_path(turns, faults_of(turns))[2]
        assert len([r for r in own if r.edit != "I"]) == len(turns)


def test_all_splits_give_the_same_cells():
    """The full chart, over all spans and all splits, has the cells that one split for each span gives."""
    rng = random.Random(1)
    for n in (1, 2, 3, 5, 8, 13):
        turns = [(rng.choice("suao"), rng.choice("..tbd")) for _ in range(n)]
        chart = {(i, i + 1): repair_grammar.terminal(*turns[i]) for i in range(n)}
        for length in range(2, n + 1):
            for i in range(n - length + 1):
                parts = [repair_grammar.combined(chart[i, k], chart[k, i + length]) for k in range(i + 1, i + length)]
                assert len(set(parts)) == 1
                chart[i, i + length] = parts[0]
        assert repair_grammar.block_cells("".join(t[0] for t in turns), "".join(t[1] for t in turns)) == chart[0, n]


def test_empty_table(spark):
    assert conversation_repair.damaged_and_repaired(table(spark, rows_of(1)).limit(0)).count() == 0
    assert conversation_repair.repaired_turns(table(spark, rows_of(1)).limit(0)).count() == 0


def test_no_turns_left(spark):
    dropped = next(i for i in range(1000) if binascii.crc32(f"{i}:0".encode()) % 20 == 0)
    (row,) = conversation_repair.damaged_and_repaired(table(spark, [(dropped, 0, "user", "Hi.")])).collect()
    assert tuple(row) == (dropped, 0, 0, 0, 0, 0, 0, "", sha(""))
