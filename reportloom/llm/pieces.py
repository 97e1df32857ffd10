"""SentencePiece ids through a table of distinct chunks.

No piece of the model crosses from a character to a following whitespace marker, and characters outside all pieces are
spelled as bytes by themselves. So a text falls into chunks (marked words) whose segmentation does not depend on what stands
around them. `chunk_pattern` reads from the model whether these conditions hold and raises if they don't.

Documents are cut into chunks in blocks of a bounded size: a block is the list of its distinct chunks and, for each position
of its documents, a number in that list. The lists go by hash to the buckets of one table of distinct chunks for all documents,
where each is segmented once, whatever the number of blocks that hold it. A block gets its list's ids back and puts them at the
positions. Blocks are written bucketed by their name, so that only the lists travel, compressed, one row for each block and bucket.
A task of the table holds the distinct chunks of its buckets, whose number follows `spark.sql.shuffle.partitions`.

Cases: a null text is empty and has no ids; repeated rows and null ids stay; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import zstandard
from pyspark.sql import DataFrame

from .common import give_back, sha256_text, shared_folder, task_step, texts

MARK = "▁"
#: Characters of a block of documents; a longer document is a block of its own.
BLOCK_CHARS = 16_000_000
#: Buckets of the chunk table, at least; a cluster's `spark.sql.shuffle.partitions` gives more.
LEAST_BUCKETS = 64
#: Rows of a batch that goes out.
ROWS_OUT = 200


@cache
def processor(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


@cache
def chunk_pattern(model: str) -> re.Pattern:
    """Chunks: whitespace markers with what follows up to the next marker, cut also around line breaks."""
    sp = processor(model)
    pieces = [sp.id_to_piece(i) for i in range(sp.vocab_size()) if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i))]
    if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
        raise ValueError("this model has pieces across whitespace markers")
    if any("\n" in p for p in pieces) or sp.encode("a\nb", out_type=str) != [f"{MARK}a", "<0x0A>", "b"]:
        raise ValueError("this model does not spell line breaks as bytes")
    if sp.encode("a  b", out_type=str)[0] != f"{MARK}a" or sp.decode(sp.encode(" a  b ")) != " a  b ":
        raise ValueError("this model does not keep spaces or puts no marker in front")
    return re.compile(f"\n|[ {MARK}]+[^ {MARK}\n]*|[^ {MARK}\n]+")


class Segmenter:
    """Ids of chunks as text, which takes little memory and is joined as it is."""

    def __init__(self, model: str):
        self.sp = processor(model)
        self.line_break = self.sp.encode("\n")[1:]
        n = self.sp.vocab_size()
        special = [self.sp.is_control(i) or self.sp.is_byte(i) or self.sp.is_unknown(i) for i in range(n)]
        self.numbers = [str(i) for i in range(n)]
        self.plain = [None if special[i] else self.sp.id_to_piece(i).replace(MARK, " ") for i in range(n)]

    def _decode(self, ids: list[int]) -> str:
        try:
            return "".join([self.plain[i] for i in ids])
        except TypeError:  # bytes: only the library joins them to characters
            return self.sp.decode(self.line_break + ids).removeprefix("\n")

    def learn(self, chunks: list[str], known: dict[str, str], changed: dict[str, str]) -> None:
        """Segment new chunks in two calls: their ids go to `known`, and to `changed` what ids decode to if not to the chunk with spaces for markers.

        The library puts a marker in front; chunks without one get a line break there.
        """
        marked = [c for c in chunks if c[0] in (" ", MARK)]
        bare = [c for c in chunks if c[0] not in (" ", MARK)]
        skip = 1 + len(self.line_break)
        all_ids = self.sp.encode([c[1:] for c in marked], num_threads=1) if marked else []
        all_ids += [ids[skip:] for ids in self.sp.encode(["\n" + c for c in bare], num_threads=1)] if bare else []
        numbers = self.numbers
        for chunk, ids in zip(marked + bare, all_ids, strict=True):
            if len(chunk) == 1 and chunk in (" ", MARK):
                ids = [self.sp.piece_to_id(MARK)]
            known[chunk] = ",".join([numbers[i] for i in ids])
            if (text := self._decode(ids)) != chunk.replace(MARK, " "):
                changed[chunk] = text


@cache
def segmenter(model: str) -> Segmenter:
    """One per worker process; it keeps nothing of the data."""
    return Segmenter(model)


def squeezed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def packed(chunks: list[str]) -> bytes:
    """Chunks as lines. A line break is a chunk by itself and no chunk is empty, so it becomes an empty line."""
    return squeezed("\n".join(["" if c == "\n" else c for c in chunks]).encode())


def unpacked(data: bytes) -> list[str]:
    return [c or "\n" for c in zstandard.decompress(data).decode().split("\n")]


def planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers, byte by byte of their rank: the high bytes are nearly all alike."""
    return squeezed(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1).T).view("<u4").ravel()


class Block:
    """Documents as numbers of their distinct chunks."""

    def __init__(self, pattern: re.Pattern):
        self.pattern, self.chars, self.numbers = pattern, 0, {}
        self.codes: list[np.ndarray] = []
        self.rows: list[pa.RecordBatch] = []

    def add(self, text: str, row: pa.RecordBatch) -> None:
        numbers = self.numbers
        chunks = self.pattern.findall(f"{MARK}{text}") if text else []
        for chunk in chunks:
            if chunk not in numbers:
                numbers[chunk] = len(numbers)
        self.codes.append(np.fromiter(map(numbers.__getitem__, chunks), np.uint32, len(chunks)))
        self.rows.append(row)
        self.chars += len(text)

    def record(self, buckets: int) -> dict:
        chunks = list(self.numbers)
        bucket = np.fromiter((zlib.crc32(c.encode()) % buckets for c in chunks), np.int64, len(chunks))
        order = np.argsort(bucket, kind="stable")
        used, starts = np.unique(bucket[order], return_index=True)
        packs = [{"bucket": int(b), "chunks": packed([chunks[i] for i in own])} for b, own in zip(used, np.split(order, starts[1:]), strict=True)] if len(chunks) else []
        sink = pa.BufferOutputStream()
        table = pa.Table.from_batches(self.rows).combine_chunks()
        table = table.append_column("chunks in a row", pa.array([len(c) for c in self.codes], pa.int64()))
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        codes = np.concatenate(self.codes)
        return {"block": uuid.uuid4().hex, "docs": squeezed(sink.getvalue().to_pybytes()), "codes": planes(codes), "places": planes(bucket), "packs": packs}


def blocks_of(source: DataFrame, model: str, buckets: int) -> DataFrame:
    """A row for each block: its documents' columns, the chunk numbers, the bucket of each number, and the chunks of each bucket.

    Blocks get random names, so the result has to be written before it is used twice.
    """
    schema = pa.schema([("block", pa.string()), ("docs", pa.binary()), ("codes", pa.binary()), ("places", pa.binary()), ("packs", pa.list_(pa.struct([("bucket", pa.int32()), ("chunks", pa.binary())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = chunk_pattern(model)
        block = Block(pattern)
        for batch in batches:
            # Copied: a block's rows would hold the whole message that their batch came in, texts included.
            rows = batch.drop_columns(["text"]).take(pa.array(range(batch.num_rows), pa.int64()))
            for i, text in enumerate(batch["text"].to_pylist()):
                if block.rows and block.chars + len(text) > BLOCK_CHARS:
                    yield pa.RecordBatch.from_pylist([block.record(buckets)], schema)
                    block = Block(pattern)
                block.add(text, rows.slice(i, 1))
        if block.rows:
            yield pa.RecordBatch.from_pylist([block.record(buckets)], schema)

    return task_step(source, run, "block string, docs binary, codes binary, places binary, packs array<struct<bucket:int,chunks:binary>>")


def bucketed(blocks: DataFrame, buckets: int) -> DataFrame:
    """`blocks` as a table in the shared folder, bucketed by `block`: what is joined by block later comes to it."""
    spark = blocks.sparkSession
    name = f"piece_blocks_{uuid.uuid4().hex}"
    blocks.write.format("parquet").bucketBy(buckets, "block").option("path", f"{shared_folder(spark)}/{name}").saveAsTable(name)
    return spark.table(name)


def segmented(packs: DataFrame, model: str, buckets: int) -> DataFrame:
    """The table of distinct chunks: for each of `packs` (`block`, `bucket`, `chunks`) the ids of its chunks, one line each, and the chunks that decode to something else."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, str] = {}
        changed: dict[str, str] = {}
        for batch in batches:
            ids, at, instead = [], [], []
            for data in batch["chunks"].to_pylist():
                chunks = unpacked(data)
                if new := [c for c in chunks if c not in known]:
                    segmenter(model).learn(new, known, changed)
                ids.append(squeezed("\n".join([known[c] for c in chunks]).encode()))
                other = [(i, changed[c]) for i, c in enumerate(chunks) if c in changed]
                at.append([i for i, _ in other])
                instead.append([t for _, t in other])
            columns = [batch["block"], batch["bucket"], pa.array(ids, pa.binary()), pa.array(at, pa.list_(pa.int32())), pa.array(instead, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["block", "bucket", "ids", "changed", "instead"])

    return task_step(packs.repartition(buckets, "bucket"), run, "block string, bucket int, ids binary, changed array<int>, instead array<string>")


class Filled:
    """A block whose chunks get their ids and texts, bucket by bucket."""

    def __init__(self, block: dict, answers: list[dict]):
        self.docs = pa.ipc.open_stream(zstandard.decompress(block["docs"])).read_all()
        self.codes, bucket = from_planes(block["codes"]), from_planes(block["places"])
        order = np.argsort(bucket, kind="stable")
        in_order = bucket[order]
        self.ids, self.texts = np.empty(len(bucket), object), np.empty(len(bucket), object)
        by_bucket = {answer["bucket"]: answer for answer in answers}
        for pack in block["packs"]:
            answer = by_bucket[pack["bucket"]]
            low, high = np.searchsorted(in_order, [pack["bucket"], pack["bucket"] + 1])
            own = unpacked(pack["chunks"])
            for i, text in zip(answer["changed"], answer["instead"], strict=True):
                own[i] = text
            self.ids[order[low:high]] = zstandard.decompress(answer["ids"]).decode().split("\n")
            self.texts[order[low:high]] = own

    def rows(self) -> Iterator[tuple[pa.Table, list[str], list[str]]]:
        """Some documents at a time: their columns, joined ids, and decoded texts."""
        ends = np.cumsum(self.docs["chunks in a row"].to_numpy())
        bounds = np.concatenate([[0], ends])
        docs = self.docs.drop_columns(["chunks in a row"])
        for first in range(0, docs.num_rows, ROWS_OUT):
            ids, decoded = [], []
            for i in range(first, min(first + ROWS_OUT, docs.num_rows)):
                own = self.codes[bounds[i] : bounds[i + 1]]
                ids.append(",".join(self.ids[own].tolist()))
                decoded.append("".join(self.texts[own].tolist()).replace(MARK, " ")[1:])
            yield docs.slice(first, ROWS_OUT), ids, decoded


def _through_table(docs: DataFrame, model: str, keep: tuple[str, ...], finish: Callable[[list[str], list[str]], dict[str, pa.Array]], schema: str) -> DataFrame:
    """`doc_id`, the columns in `keep`, and what `finish` makes of joined ids and decoded texts."""
    source = texts(docs, *keep)
    buckets = max(LEAST_BUCKETS, int(source.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    blocks = bucketed(blocks_of(source, model, buckets), buckets)
    answers = segmented(blocks.select("block", F.explode("packs").alias("pack")).select("block", "pack.*"), model, buckets)
    kept = "".join(f", `{c}` {t}" for c, t in source.select(*keep).dtypes) if keep else ""

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        parts = []
        for row in block.to_pylist():
            for rows, ids, decoded in Filled(row, answers.to_pylist()).rows():
                columns = {name: rows[name].combine_chunks() for name in rows.column_names} | finish(ids, decoded)
                parts.append(pa.table(columns))
        give_back()
        return pa.concat_tables(parts)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, f"doc_id long{kept}, {schema}")


def encoded(docs: DataFrame, model: str, *keep: str) -> DataFrame:
    """`doc_id`, the columns in `keep`, `ids` and `text` decoded from the ids."""

    def finish(ids: list[str], decoded: list[str]) -> dict[str, pa.Array]:
        return {"ids": pa.array([list(map(int, x.split(","))) if x else [] for x in ids], pa.list_(pa.int32())), "text": pa.array(decoded, pa.string())}

    return _through_table(docs, model, keep, finish, "ids array<int>, text string")


def encoded_digest(docs: DataFrame, model: str) -> DataFrame:
    """`doc_id`, the number of ids, and digests of the ids and of the decoded text."""

    def finish(ids: list[str], decoded: list[str]) -> dict[str, pa.Array]:
        return {
            "n_tokens": pa.array([x.count(",") + 1 if x else 0 for x in ids], pa.int64()),
            "ids_sha256": pa.array(map(sha256_text, ids), pa.string()),
            "decoded_sha256": pa.array(map(sha256_text, decoded), pa.string()),
        }

    return _through_table(docs, model, (), finish, "n_tokens long, ids_sha256 string, decoded_sha256 string")
