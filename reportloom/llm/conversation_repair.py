"""Conversation structure repair: the cheapest edits that make a conversation's turns alternate, by weighted interval parsing.

`repair_grammar` holds the grammar and the cells. Here the turns are put in order, their faults found, and spans of
at most `BLOCK_TURNS` turns parsed in parallel, wherever they lie: a long conversation spreads over many range partitions, and only
cells of its spans meet in one task. Then its turns pass by once, in order, and the audit is applied to them; no task holds more
than an Arrow batch of texts. One conversation's repaired text is hashed in one task, as a hash has no parts.

Faults, the first of them counts: blank (no character but spaces), duplicate (an earlier turn has the role and text), truncated (the last
character that is no space is none of `.!?`). Blank and duplicate turns are deleted, truncated ones cost more to keep.

Cases: null roles and texts are one space; turns are in order of `turn`, nulls first, then of role and of the text's SHA-256, so ties and
repeated rows have one order; a role without a first letter `s`, `u` or `a` (an empty or null one as well) can't be kept; null ids
are one conversation; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from .common import prepare, task_step, written
from .quality_rules import SPACES
from .repair_grammar import BLANK, DELETE, DUPLICATE, INSERT, KEPT, SOUND, TRUNCATED, Cells, Replay, block_cells, cheapest, illegal_pairs, whole_span

BLOCK_TURNS = 256
SPACE = " "
KEY = ["conv_id", "turn", "role", "hash"]


def plain_turns(conversations: DataFrame) -> DataFrame:
    """`conv_id`, `turn`, `role`, `text`, with one space for null roles and texts."""
    prepare(conversations.sparkSession)
    named = [F.coalesce(F.col(name).cast("string"), F.lit(SPACE)).alias(name) for name in ("role", "text")]
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *named)


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns with planted faults: by a checksum of `conv_id:turn`, one in 20 each is dropped, emptied, stripped of its
    sentence ends, repeated, or given to the user."""
    turns = plain_turns(conversations)
    named = F.concat_ws(":", *(F.coalesce(F.col(name).cast("string"), F.lit(SPACE)) for name in ("conv_id", "turn")))
    turns = turns.withColumn("damage", F.crc32(named.cast("binary")) % 20).where("damage <> 0")
    text = F.when(F.col("damage") == 1, F.lit("")).when(F.col("damage") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("damage") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("damage") == 3, F.lit(2)).otherwise(F.lit(1)))).alias("copy")
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies).drop("copy")


def _hash() -> Column:
    return F.unhex(F.sha2("text", 256)).alias("hash")


def _marked(turns: DataFrame) -> DataFrame:
    """Different turns with their number `n` and fault, in order; in front of the first turn with its role and text stands a mark (`kind` 0)."""
    bare = F.btrim(F.col("text"), F.lit(SPACES))
    fault = F.when(bare == "", F.lit(BLANK)).when(F.substring(bare, -1, 1).isin(".", "!", "?"), F.lit(SOUND)).otherwise(F.lit(TRUNCATED))
    different = turns.select("conv_id", "turn", "role", _hash(), fault.alias("fault")).groupBy(*KEY, "fault").agg(F.count(F.lit(1)).alias("n"))
    different = written(different, "different-turns")
    first = different.groupBy("conv_id", "role", "hash").agg(F.min(F.struct("turn")).alias("first"))
    marks = first.select("conv_id", "first.turn", "role", "hash", F.lit("").alias("fault"), F.lit(0).cast("long").alias("n"), F.lit(0).alias("kind"))
    return different.withColumn("kind", F.lit(1)).unionByName(marks).repartitionByRange(*KEY).sortWithinPartitions(*KEY, "kind")


class _Block:
    """Turns of a conversation in a row, up to `BLOCK_TURNS`; `seq` tells blocks apart that begin at equal turns."""

    def __init__(self, key: tuple, seq: int) -> None:
        self.key, self.seq = key, seq
        self.initials, self.faults = "", ""
        self.first_turn, self.last_turn, self.n_turns = None, None, 0

    def add(self, turn: int | None, initial: str, faults: str) -> None:
        if turn is not None and turn != self.last_turn:
            self.n_turns += 1
            self.first_turn, self.last_turn = turn if self.first_turn is None else self.first_turn, turn
        self.initials += initial * len(faults)
        self.faults += faults


_BLOCK = "conv_id long, turn long, role string, hash binary, seq long, initials string, faults string, first_turn long, last_turn long, n_turns long, costs array<long>, audits array<string>"
_BLOCK_NAMES = [part.split()[0] for part in _BLOCK.split(", ")]


def _block_batch(blocks: list[_Block]) -> pa.RecordBatch:
    cells = [block_cells(b.initials, b.faults) for b in blocks]
    columns = [
        *(pa.array([b.key[k] for b in blocks], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.string(), pa.binary()))),
        pa.array([b.seq for b in blocks], pa.int64()),
        pa.array([b.initials for b in blocks], pa.string()),
        pa.array([b.faults for b in blocks], pa.string()),
        pa.array([b.first_turn for b in blocks], pa.int64()),
        pa.array([b.last_turn for b in blocks], pa.int64()),
        pa.array([b.n_turns for b in blocks], pa.int64()),
        pa.array([[None if c is None else c[0] for c in own] for own in cells], pa.list_(pa.int64())),
        pa.array([[None if c is None else c[1] for c in own] for own in cells], pa.list_(pa.string())),
    ]
    return pa.RecordBatch.from_arrays(columns, _BLOCK_NAMES)


def parsed_blocks(turns: DataFrame, size: int = BLOCK_TURNS) -> DataFrame:
    """Spans of at most `size` turns with their first turn, initials, faults and cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full: list[_Block] = []
        block: _Block | None = None
        marked = None
        seq = 0
        for batch in batches:
            rows = zip(*(batch[name].to_pylist() for name in (*KEY, "kind", "fault", "n")), strict=True)
            for *key, kind, fault, n in rows:
                if kind == 0:
                    marked = key
                    continue
                initial = key[2][:1] if key[2][:1] in KEPT else "o"
                if fault == BLANK:
                    faults = [(BLANK, n)]
                elif marked == key:
                    faults = [(fault, 1), (DUPLICATE, n - 1)]
                else:
                    faults = [(DUPLICATE, n)]
                for letter, count in faults:
                    while count:
                        if block is None or block.key[0] != key[0] or len(block.faults) >= size:
                            if block is not None:
                                full.append(block)
                            block, seq = _Block(tuple(key), seq + 1), seq + 1
                        some = min(count, size - len(block.faults))
                        block.add(key[1], initial, letter * some)
                        count -= some
                        if len(full) >= 200:
                            yield _block_batch(full)
                            full = []
        if block is not None:
            yield _block_batch([*full, block])

    return task_step(_marked(turns), run, _BLOCK)


class _Conversation:
    """Totals of one conversation from its blocks, and the edits of its turns."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id = conv_id
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.n_turns, self.first_turn, self.last_turn = 0, None, None
        self._last_initial = ""
        self._cells: list[Cells] = []
        self._replay: Replay | None = None

    def add_block(self, initials: str, faults: str, first_turn: int | None, last_turn: int | None, n_turns: int, costs: list, audits: list) -> None:
        self.blank += faults.count(BLANK)
        self.duplicate += faults.count(DUPLICATE)
        self.truncated += faults.count(TRUNCATED)
        self.illegal += illegal_pairs(self._last_initial + initials)
        self._last_initial = initials[-1]
        if n_turns:
            self.n_turns += n_turns - (first_turn == self.last_turn)
            self.first_turn, self.last_turn = first_turn if self.first_turn is None else self.first_turn, last_turn
        self._cells.append(tuple(None if c is None else (c, a) for c, a in zip(costs, audits, strict=True)))

    def edits(self) -> Replay:
        if self._replay is None:
            self.cost, self.audit = cheapest(whole_span(self._cells))
            self._cells = []
            self._replay = Replay(self.audit)
        return self._replay

    @property
    def gaps(self) -> int:
        return 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.n_turns


def _in_order(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """For each conversation, in this order: a row that names it, its blocks, its turns."""
    blocks = written(parsed_blocks(turns), "turn-blocks").withColumn("kind", F.lit(1))
    names = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().withColumn("kind", F.lit(0))
    rows = turns.select("conv_id", "turn", "role", "text", _hash(), F.lit(2).alias("kind"))
    every = names.unionByName(blocks, allowMissingColumns=True).unionByName(rows, allowMissingColumns=True)
    return every.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "hash", "seq")


#: Edit, turn, role and text of an inserted, kept or deleted turn; None at the end of a conversation.
Event = tuple[str, int | None, str | None, str] | None


def _events(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Conversation, Event]]:
    own: _Conversation | None = None

    def finished() -> Iterator[tuple[_Conversation, Event]]:
        if own is not None:
            for role in own.edits().inserts():
                yield own, (INSERT, None, role, "")
            yield own, None

    names = ("conv_id", "kind", "turn", "role", "text", "initials", "faults", "first_turn", "last_turn", "n_turns", "costs", "audits")
    for batch in batches:
        for conv_id, kind, turn, role, text, *block in zip(*(batch[n].to_pylist() for n in names), strict=True):
            if kind == 0:
                yield from finished()
                own = _Conversation(conv_id)
            elif kind == 1:
                own.add_block(*block)
            else:
                edits = own.edits()
                for inserted in edits.inserts():
                    yield own, (INSERT, None, inserted, "")
                letter, after = edits.edit(role)
                yield own, (letter, turn, after, text)
    yield from finished()


def _collected(names: list[str], kinds: list[pa.DataType], rows: Iterator[tuple], size: int) -> Iterator[pa.RecordBatch]:
    part: list[tuple] = []
    held = 0
    for row in rows:
        part.append(row)
        held += sum(len(x) for x in row if isinstance(x, str))
        if len(part) == size or held > 1 << 24:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part, strict=True), kinds, strict=True)], names)
            part, held = [], 0
    if part:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part, strict=True), kinds, strict=True)], names)


def _step(rows: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]], columns: dict[str, tuple[str, pa.DataType]]) -> tuple[Callable, str]:
    names, kinds = list(columns), [kind for _, kind in columns.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _collected(names, kinds, rows(batches), 500)

    return run, ", ".join(f"{name} {sql}" for name, (sql, _) in columns.items())


_LONG, _TEXT = ("long", pa.int64()), ("string", pa.string())


def repaired_turns(conversations: DataFrame) -> DataFrame:
    """`conv_id`, `place` (from 0), `edit`, `turn`, `role`, `text` of each turn after the repair; deleted turns have no place and role."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        place = 0
        for own, event in _events(batches):
            if event is None:
                place = 0
                continue
            letter, turn, role, text = event
            yield own.conv_id, None if letter == DELETE else place, letter, turn, role, text
            place += letter != DELETE

    run, schema = _step(rows, {"conv_id": _LONG, "place": _LONG, "edit": _TEXT, "turn": _LONG, "role": _TEXT, "text": _TEXT})
    return task_step(_in_order(conversations, plain_turns(conversations)), run, schema)


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    text_hash, lines = hashlib.sha256(), 0
    for own, event in _events(batches):
        if event is None:
            yield own.conv_id, own.gaps, own.blank, own.duplicate, own.truncated, own.illegal, own.cost, own.audit, text_hash.hexdigest()
            text_hash, lines = hashlib.sha256(), 0
        elif event[0] != DELETE:
            text_hash.update(f"{chr(10) if lines else ''}{event[2]}:{event[3]}".encode())
            lines += 1


def repair_digest(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """Faults, cost, audit and the hash of the repaired text of each conversation of `conversations`, whose rows are now `turns`."""
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    run, schema = _step(_digest_rows, {"conv_id": _LONG, **dict.fromkeys(longs, _LONG), "audit": _TEXT, "repaired_sha256": _TEXT})
    return task_step(_in_order(conversations, turns), run, schema)


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    return repair_digest(conversations, damaged(conversations))
