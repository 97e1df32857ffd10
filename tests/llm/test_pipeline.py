import corpus_pipeline
from reportloom.llm import pieces
from reportloom.llm.common import table
from reportloom.llm.queries import PIECE_MODEL, tokenizer_path
from test_duplicates import plain_classes, plain_lines

BASE = "/root/testdata/sf0.001"


def test_stages_are_in_order_and_keep_the_columns(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "sentence_pieces"]
    docs = table(spark, BASE, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        empty = stage(spark, docs.limit(0), BASE)
        assert empty.schema.simpleString() == docs.schema.simpleString() and empty.count() == 0


def test_each_stage_on_the_input_of_its_predecessor(spark):
    docs = table(spark, BASE, "documents")
    stages = dict(corpus_pipeline.STAGES)
    calm = stages["toxicity"](spark, docs, BASE)
    lines = stages["line_dedup"](spark, calm, BASE)
    rows = [(r.doc_id, r.text) for r in calm.collect()]
    import hashlib

    want = {doc_id: (n, gone, sha) for doc_id, n, gone, sha in plain_lines(rows)}
    have = {r.doc_id: r for r in lines.collect()}
    assert set(have) == {i for i, (n, gone, _) in want.items() if not gone or gone < n}
    assert all(hashlib.sha256(r.text.encode()).hexdigest() == want[i][2] and r.n_chars == len(r.text) for i, r in have.items())
    unique = stages["near_dedup"](spark, lines, BASE)
    classes = plain_classes([(r.doc_id, r.text) for r in have.values()])
    assert sorted(r.doc_id for r in unique.collect()) == sorted(set(classes.values()))
    clean = stages["decontamination"](spark, unique, BASE)
    assert clean.join(unique, "doc_id").count() == clean.count() <= unique.count()
    library = pieces.processor(tokenizer_path(PIECE_MODEL))
    texts = {r.doc_id: r.text for r in clean.collect()}
    last = stages["sentence_pieces"](spark, clean, BASE).collect()
    assert {r.doc_id: (r.ids, r.text) for r in last} == {i: (library.encode(t), library.decode(library.encode(t))) for i, t in texts.items()}
    ran = corpus_pipeline.run(spark, BASE)
    assert sorted(map(str, ran.collect())) == sorted(map(str, last))
