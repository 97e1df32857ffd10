"""Benchmark decontamination by template canonicalisation, which also finds re-parameterised questions.

Numbers, names and units become typed placeholders, all other words are taken without case. Windows of `WINDOW` such tokens of the
benchmark items are hash-joined with those of the documents. Names that follow each other with one space in between are one
placeholder. Hits of a document and an item that lie on one diagonal (same distance of places) belong together. They count if they
cover `MIN_COVER` of the item and their slots are consistent: each value in the item always stands for the same value in the
document, and different names for different names. Windows with more placeholders than plain words are weak evidence: with
them the diagonal has to cover `SLOT_COVER` of the item. Words put in between move an item to further diagonals: those that
lie within twice the item's length, in the item's order, count together if they cover `CHAIN_COVER` of it.

In front of the join stands a bit map of `MAP_BITS` bits, whatever the benchmark's size: windows whose bit is not set cannot
join and are never shuffled. A large benchmark makes the map less selective and changes no result.

An item of fewer than `WINDOW` tokens is one window of its own length. A template window needs at least `SHORTEST` tokens and
`PLAIN_WORDS` plain words, as placeholders alone are no evidence. Beside them stand windows of the tokens without placeholders,
whatever their length and slots, on diagonals of their own: so verbatim copies of all items are found, of the shortest ones too. Cases: null texts are empty; rows that agree in doc_id
and text are treated alike; null ids stay; empty tables give an empty result; further columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from .common import arrow_step, prepare, text_key, texts, written
from .kernels import LOWER, as_long, mix, running_sums, slices, spans, strings

WINDOW, SHORTEST, PLAIN_WORDS = 8, 4, 2
#: Shares of an item's tokens that hits have to cover: on one diagonal, on one with weak windows, on several.
MIN_COVER, SLOT_COVER, CHAIN_COVER = 0.5, 0.9, 0.75
MAP_BITS = 1 << 22
NUMBER, NAME, UNIT = 1, 2, 3

#: Units, which count only after a number, and words that are capital at the start of sentences without being names.
UNITS = (
    "kg g mg lb lbs oz km m cm mm mi ft in mile miles metre metres meter meters foot feet inch inches litre litres liter liters l ml "
    "hour hours h minute minutes min second seconds s day days week weeks month months year years percent dollar dollars euro euros "
    "cent cents pound pounds degree degrees kilometer kilometers kilogram kilograms gram grams"
)
SENTENCE_STARTERS = (
    "a an the this that these those he she it they we you i if when while what which who how why where is are was were do does did can "
    "in on at by for from to of and or but as with each every there then let suppose given find after before"
)

_CLASS = np.full(256, 2, np.uint8)  # 0 gap, 1 digit, 2 letter
_CLASS[:128] = 0
_CLASS[ord("0") : ord("9") + 1] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("a") : ord("z") + 1] = 2


def _known(words: str) -> np.ndarray:
    raw = [w.encode() for w in words.split()]
    ends = np.cumsum([len(w) for w in raw])
    sums = running_sums(np.frombuffer(b"".join(raw), np.uint8))
    return np.sort(spans(sums, ends - [len(w) for w in raw], ends))


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


class Tokens:
    """Canonical tokens of some texts: `canon` hashes, `kind` of placeholder (0: plain word), `value` hashes, `first` by text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        kind = _CLASS[data]
        change = np.empty(len(kind) + 1, bool)
        change[:1] = change[-1:] = True
        change[1:-1] = kind[1:] != kind[:-1]
        change[offsets] = True
        cuts = np.flatnonzero(change)
        starts, ends = cuts[:-1], cuts[1:]
        filled = kind[starts] > 0
        starts, ends = starts[filled], ends[filled]
        number = kind[starts] == 1
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        # Numbers with one sign in between, such as 1,000 or 2.5, are one token.
        joined = np.zeros(len(starts), bool)
        if len(starts):
            gap = starts[1:] - ends[:-1]
            sign = data[np.minimum(ends[:-1], len(data) - 1)]
            joined[1:] = number[1:] & number[:-1] & (gap == 1) & ((sign == ord(".")) | (sign == ord(","))) & ~edge[ends[:-1]] & ~edge[starts[1:]]
        head = np.flatnonzero(~joined)
        ends = ends[np.append(head[1:], len(starts)) - 1] if len(head) else ends[:0]
        starts, number = starts[head], number[head]
        sums = running_sums(LOWER[data])
        self.value = spans(sums, starts, ends)
        byte, after = data[starts], data[np.minimum(starts + 1, len(data) - 1)]
        capital = (byte >= ord("A")) & (byte <= ord("Z"))
        wide = (byte == 0xC3) & (after >= 0x80) & (after <= 0x9E)
        third = data[np.minimum(starts + 2, len(data) - 1)]
        follows = np.where(wide, third, after)
        small = ((follows >= ord("a")) & (follows <= ord("z"))) | (follows >= 128)
        long_enough = ends - starts > np.where(wide, 2, 1)
        name = (capital | wide) & small & long_enough & ~_among(self.value, _STARTERS)
        after_number = np.zeros(len(starts), bool)
        after_number[1:] = number[:-1]
        self.first = np.searchsorted(starts, offsets)
        after_number[self.first[:-1][self.first[:-1] < len(starts)]] = False
        unit = after_number & ~number & _among(self.value, _UNITS)
        kind = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, 0))).astype(np.int8)
        # The template's tokens: a run of names is one of them, whose value is that of the whole run.
        one_space = np.zeros(len(starts), bool)
        if len(starts):
            one_space[1:] = (starts[1:] - ends[:-1] == 1) & (data[np.minimum(ends[:-1], len(data) - 1)] == ord(" ")) & ~edge[ends[:-1]] & ~edge[starts[1:]]
        goes_on = np.zeros(len(starts), bool)
        goes_on[1:] = (kind[1:] == NAME) & (kind[:-1] == NAME) & one_space[1:]
        head = np.flatnonzero(~goes_on)
        last = np.append(head[1:], len(starts)) - 1 if len(head) else head
        self.kind = kind[head]
        self.slot = spans(sums, starts[head], ends[last]) if len(head) else self.value[:0]
        self.canon = np.where(self.kind > 0, mix(self.kind.astype(np.uint64), 5), self.value[head])
        self.template_first = np.searchsorted(head, self.first)

    def windows(self, n: int, raw: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of windows of `n` tokens: without placeholders (`raw`), or of the template and with enough plain words."""
        first, own = (self.first, self.value) if raw else (self.template_first, self.canon)
        room = np.repeat(first[1:], np.diff(first)) - np.arange(len(own))
        at = np.flatnonzero(room >= n)
        if not raw:
            at = at[n - self.n_slots(at, n) >= PLAIN_WORDS]
        return at, spans(running_sums(own), at, at + n, (200 if raw else 100) + n)

    def n_slots(self, at: np.ndarray, n: int) -> np.ndarray:
        slots = np.concatenate([[0], np.cumsum(self.kind > 0)])
        return slots[at + n] - slots[at]


_UNITS, _STARTERS = _known(UNITS), _known(SENTENCE_STARTERS)
_SLOTS = pa.list_(pa.struct([("o", pa.int32()), ("kind", pa.int32()), ("v", pa.int64())]))
WINDOWS = "id long, key long, h long, raw boolean, weak boolean, p int, n int, size int, slots array<struct<o: int, kind: int, v: long>>"


def _hits(df: DataFrame, bits, lengths: list[int] | None) -> DataFrame:
    """Windows of each text with their slots: all lengths an item needs (`lengths` None), or those whose bit is set."""

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = strings(batch["text"])
        for i, j in slices(offsets):
            tokens = Tokens(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            firsts = {True: tokens.first, False: tokens.template_first}
            every = np.unique(np.concatenate([np.diff(first) for first in firsts.values()]))
            own = lengths or sorted({WINDOW, *(int(c) for c in every if 0 < c < WINDOW)})
            for n, raw in ((n, raw) for n in own for raw in (False, True) if raw or n >= SHORTEST):
                first = firsts[raw]
                counts = np.diff(first)
                at, h = tokens.windows(n, raw)
                text = np.searchsorted(first, at, "right") - 1
                if bits is not None:
                    keep = bits.value[h % np.uint64(MAP_BITS)]
                else:
                    keep = (counts[text] == n) | (n == WINDOW)
                at, h, text = at[keep], h[keep], text[keep]
                if not len(at):
                    continue
                slots = [[]] * len(at) if raw else []
                for t in [] if raw else at.tolist():
                    spots = np.flatnonzero(tokens.kind[t : t + n])
                    slots.append([{"o": int(o), "kind": int(tokens.kind[t + o]), "v": int(as_long(tokens.slot)[t + o])} for o in spots])
                weak = np.zeros(len(at), bool) if raw else 2 * tokens.n_slots(at, n) > n
                where = pa.array(i + text)
                numbers = [(at - first[text]).astype(np.int32), np.full(len(at), n, np.int32), counts[text].astype(np.int32)]
                columns = [batch["id"].take(where), batch["key"].take(where), pa.array(as_long(h)), pa.array(np.full(len(at), raw)), pa.array(weak), *map(pa.array, numbers), pa.array(slots, _SLOTS)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "key", "h", "raw", "weak", "p", "n", "size", "slots"])

    return arrow_step(df, step, WINDOWS)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`doc_id`, `key`, `item_id`, `cover` and `reparameterised` (some slot has another value) for each document and item that agree."""
    spark = prepare(docs.sparkSession)
    items = benchmark.select(
        F.col("item_id").cast("long").alias("id"), F.lit(0).cast("long").alias("key"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    wanted = written(_hits(items.where("id is not null"), None, None), "benchmark-windows")
    bits = np.zeros(MAP_BITS, bool)
    # At most MAP_BITS numbers come to the driver, however many windows there are.
    places = wanted.select(F.pmod("h", F.lit(MAP_BITS)).cast("int").alias("bit")).distinct().toPandas()
    bits[places["bit"].to_numpy(np.int64)] = True
    lengths = sorted(r.n for r in wanted.select("n").distinct().collect())  # at most WINDOW
    source = texts(docs).select(F.col("doc_id").alias("id"), text_key(F.col("text")).alias("key"), "text")
    found = _hits(source, spark.sparkContext.broadcast(bits), lengths or [WINDOW])
    theirs = wanted.select(F.col("id").alias("item_id"), "h", "raw", "n", F.col("size"), F.col("p").alias("q"), F.col("slots").alias("item_slots"))
    hits = found.select(F.col("id").alias("doc_id"), "key", "h", "raw", "weak", "n", "p", "slots").join(theirs, ["h", "raw", "n"])
    pairs = F.zip_with(
        "slots", "item_slots", lambda x, y: F.struct(x["kind"].alias("kind"), y["v"].alias("theirs"), x["v"].alias("ours"))
    )
    hits = hits.withColumns({"shift": F.col("p") - F.col("q"), "pairs": pairs})
    same = ["doc_id", "key", "item_id", "size", "raw"]
    # A stretch of the text of twice the item's length, from each item's length on: an item with words put in lies within one.
    zones = F.array_distinct(F.array(*(2 * F.floor((F.col("p") + k * F.col("size")) / (2 * F.col("size"))) + k for k in range(2))))
    hits = written(hits.withColumn("zones", zones), "benchmark-hits")

    def summed(rows: DataFrame, *more: str) -> DataFrame:
        return rows.groupBy(*same, "shift", *more).agg(
            F.collect_set(F.struct("q", "n")).alias("spots"),
            F.collect_set(F.when(~F.col("weak"), F.struct("q", "n"))).alias("strong"),
            F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("slots"),
            F.min("q").alias("from_q"),
            F.min("p").alias("from_p"),
        )

    def cover(spots: str) -> Column:
        places = F.array_distinct(F.flatten(F.transform(spots, lambda s: F.sequence(s["q"], s["q"] + s["n"] - 1))))
        return F.size(places) / F.col("size")

    alone = summed(hits).withColumn("enough", (cover("strong") >= MIN_COVER) | (cover("spots") >= SLOT_COVER))
    parts = summed(hits.withColumn("zone", F.explode("zones")), "zone").groupBy(*same, "zone").agg(F.sort_array(F.collect_list(F.struct("from_q", "from_p", "spots", "slots"))).alias("parts"))
    starts = F.transform("parts", lambda part: part["from_p"])
    chained = parts.where((F.size("parts") > 1) & (starts == F.sort_array(starts))).select(
        *same, F.flatten("parts.spots").alias("spots"), F.array_distinct(F.flatten("parts.slots")).alias("slots")
    )
    chained = chained.withColumn("enough", cover("spots") >= CHAIN_COVER)
    columns = [*same, "spots", "slots", "enough"]
    names = F.filter("slots", lambda s: s["kind"] == NAME)
    theirs_of = lambda column: F.array_distinct(F.transform(column, lambda s: F.struct(s["kind"], s["theirs"])))
    consistent = (F.size("slots") == F.size(theirs_of("slots"))) & (F.size(names) == F.size(F.array_distinct(F.transform(names, lambda s: s["ours"]))))
    return (
        alone.select(*columns)
        .unionByName(chained.select(*columns))
        .where(F.col("enough") & consistent)
        .groupBy("doc_id", "key", "item_id")
        .agg(F.max(cover("spots")).alias("cover"), F.min(F.exists("slots", lambda s: s["ours"] != s["theirs"])).alias("reparameterised"))
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that agree with no item, with all columns as they are."""
    found = contaminated(docs, benchmark).select(F.col("doc_id").alias("own_id"), F.col("key").alias("own_key")).distinct()
    found = written(found, "contaminated")
    rows = docs.select(F.struct("*").alias("doc"), text_key(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("row_key"))
    return rows.join(found, F.col("doc.doc_id").cast("long").eqNullSafe(F.col("own_id")) & (F.col("row_key") == F.col("own_key")), "left_anti").select("doc.*")
