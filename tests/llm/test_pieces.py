import random

import pyarrow as pa
import pytest

from fixtures import frame, sha
from reportloom.llm import pieces
from reportloom.llm.queries import PIECE_MODEL, tokenizer_path

PARTS = ["▁", " ", "  ", "\n", "a", "the", "é", "ß", "\t", "①", "👍🏽", "\x00", "<s>", "</s>", "<unk>", "<0x0A>", "\r", "字", ".", "1", "23", "‍", "Ing", "tion ", "\xa0", "　"]


@pytest.fixture(scope="module")
def model():
    return tokenizer_path(PIECE_MODEL)


def test_ids_and_text_equal_the_library(model):
    library, pattern, rng = pieces.processor(model), pieces.chunk_pattern(model), random.Random(3)
    known, changed = {}, {}
    for _ in range(5000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14)))
        chunks = pattern.findall(f"▁{text}") if text else []
        pieces.segmenter(model).learn([c for c in dict.fromkeys(chunks) if c not in known], known, changed)
        assert not chunks or pieces.unpacked(pieces.packed(chunks)) == chunks
        want = library.encode(text)
        assert ",".join(known[c] for c in chunks) == ",".join(map(str, want))
        assert "".join(changed.get(c, c) for c in chunks).replace("▁", " ")[1:] == library.decode(want), text


def test_each_distinct_chunk_is_segmented_once(spark, model, monkeypatch):
    """Many small blocks share words: the buckets hold each word in one task, and texts come back at their positions."""
    monkeypatch.setattr(pieces, "BLOCK_CHARS", 300)
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60)))) for i in range(400)]
    df = frame(spark, rows)
    blocks = pieces.bucketed(pieces.blocks_of(pieces.texts(df), model, 64), 64)
    assert blocks.count() > 20
    packs = blocks.selectExpr("block", "inline(packs)").select("block", "bucket", "chunks").collect()
    where = {}
    for row in packs:
        for chunk in pieces.unpacked(row.chunks):
            where.setdefault(chunk, set()).add(row.bucket)
    assert len(packs) > len({r.bucket for r in packs}) and all(len(b) == 1 for b in where.values())
    library = pieces.processor(model)
    got = {r.doc_id: (r.ids, r.text) for r in pieces.encoded(df, model).collect()}
    assert got == {i: (library.encode(t), library.decode(library.encode(t))) for i, t in rows}


def test_plan_moves_words_and_ids_but_no_blocks(spark, model):
    plan = pieces.encoded_digest(frame(spark, [(1, "a b")]), model)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 2 and plan.count("Exchange hashpartitioning(bucket") == 1
    assert "Bucketed: true" in plan


def test_query_columns_and_odd_rows(spark, model):
    library = pieces.processor(model)
    rows = [(1, "Two  words\nhere"), (2, None), (3, ""), (None, "▁x"), (1, "Two  words\nhere"), (4, "long " * 20_000), (5, "y" * 50_000)]
    got = sorted(map(tuple, pieces.encoded_digest(frame(spark, rows, clashing=True), model).collect()), key=str)
    want = []
    for doc_id, text in rows:
        ids = library.encode(text or "")
        want.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert got == sorted(want, key=str)
    full = pieces.encoded(frame(spark, rows[:3]), model, "lang").orderBy("doc_id").collect()
    assert [(r.doc_id, r.lang, r.ids, r.text) for r in full] == [
        (1, "en", library.encode("Two  words\nhere"), "Two  words\nhere"),
        (2, "en", [], ""),
        (3, "en", [], ""),
    ]
    assert pieces.encoded_digest(frame(spark, rows).limit(0), model).count() == 0


def test_a_block_does_not_hold_the_texts_of_its_documents(model, monkeypatch):
    """Rows kept for a block are copies: a batch that came as one message stays whole as long as a slice of it does."""
    class Frame:
        def mapInArrow(self, run, schema):
            return run

    held = []
    record = pieces.Block.record

    def seen(block, buckets):
        held.append(pa.total_allocated_bytes())
        return record(block, buckets)

    monkeypatch.setattr(pieces.Block, "record", seen)

    def batches():
        for k in range(20):
            batch = pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array(["word " * 100_000])], ["doc_id", "text"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema) as out:
                out.write_batch(batch)
            yield from pa.ipc.open_stream(sink.getvalue())

    before = pa.total_allocated_bytes()
    blocks = list(pieces.blocks_of(Frame(), model, 64)(batches()))
    assert sum(b.num_rows for b in blocks) == 1 and held[0] - before < 3_000_000
