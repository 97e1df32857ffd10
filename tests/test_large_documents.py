"""Documents read in byte ranges give the rows of the one-task reader, wherever they are cut."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from reportloom.queries import tables_in_out
from reportloom.sources import structure
from reportloom.sources.feed import read_feed, read_small_feed

FIELDS = ["AUFNR", "MAKTX", "SUB"]


def landed(path, texts):
    path.mkdir()
    for i, text in enumerate(texts):
        (path / f"p{i}.json").write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def rows(df):
    return sorted(tuple(r) for r in df.select(F.element_at(F.split("__file", "/"), -1), "__pos", *FIELDS).collect())


def in_ranges(spark, path, size):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        return rows(read_feed(spark, path, FIELDS))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


TRICKY = [
    '{"DATA":[{"AUFNR":"1","MAKTX":"a}b{\\"]["},{"AUFNR":"2","SUB":{"x":[{"y":"}"}]}}]}\n',
    '{"CODE": 200, "META": {"a": {"DATA": [{"AUFNR": "no"}]}, "b": {}}, "DATA": [ {"AUFNR": "ü\\\\"} , {"MAKTX": "DATA\\\\\\""} ], "END": [{"z": 1}]}',
    '{"NOTE":"DATA","DATA":{"AUFNR":"5","SUB":{"k":{"l":"}"}},"MAKTX":"[{"}}',
    '{"LIST":[[1],{"q":2}],"DATA":{"AUFNR":"6"},"L":[{}]}',
    '{"DATA":[],"X":{"Y":{}}}',
    ' \n{ "L" : [ 1 , 2 ] , "DATA" : \t[\n{}\n,\n{"AUFNR":null}\n]\n}\n\n',
]


def test_same_rows_as_the_one_task_reader(spark, tmp_path):
    path = landed(tmp_path / "feed", TRICKY)
    want = rows(read_small_feed(spark, path, FIELDS))
    assert len(want) == 8
    for size in (7, 64, 1 << 20):
        assert in_ranges(spark, path, size) == want


def test_cut_at_every_byte(spark, tmp_path):
    """Byte ranges of one byte: a cut between each two bytes of a document."""
    path = landed(tmp_path / "feed", [TRICKY[0][:-1] + "  "])
    assert in_ranges(spark, path, 1) == rows(read_small_feed(spark, path, FIELDS))


def test_random_documents(spark, tmp_path):
    rng = random.Random(3)

    def value(depth):
        kind = rng.randrange(7 if depth < 3 else 4)
        if kind < 2:
            return "".join(rng.choice('ab{}[]":,\\é\n') for _ in range(rng.randrange(6)))
        if kind < 4:
            return rng.choice([1, None, True, 2.5])
        if kind == 4:
            return [value(depth + 1) for _ in range(rng.randrange(3))]
        return {rng.choice(["AUFNR", "DATA", "k", 'q"}']): value(depth + 1) for _ in range(rng.randrange(3))}

    def order():
        return {"AUFNR": str(rng.randrange(99)), "MAKTX": "".join(rng.choice('x}{"\\') for _ in range(4)), "SUB": value(1)}

    texts = []
    for _ in range(12):
        members = [(f"m{i}", value(0)) for i in range(rng.randrange(4))]
        members.insert(rng.randrange(len(members) + 1), ("DATA", order() if rng.random() < 0.3 else [order() for _ in range(rng.randrange(6))]))
        texts.append(json.dumps(dict(members), ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1])))
    path = landed(tmp_path / "feed", texts)
    want = rows(read_small_feed(spark, path, FIELDS))
    for size in (23, 150):
        assert in_ranges(spark, path, size) == want


@pytest.mark.parametrize(
    "text, message",
    [
        ('{"DATA":[{"AUFNR":"1"}]', "not one complete JSON document"),
        ('{"DATA":[{"AUFNR":"1"}', "not one complete JSON document"),
        ('{"DATA":[{"AUFNR":"1}]}', "not one complete JSON document"),
        ('{"MESSAGE":"no rights"}', "a payload has no DATA"),
        ('{"DATA":null,"X":{"DATA":[{}]}}', "a payload has no DATA"),
        ('{"DATA":[{"AUFNR":"1"},null,{"AUFNR":"2"}]}', "an order is no object"),
        (b'{"DATA":[{"AUFNR":"\xff\xfe"}]}', "not one complete JSON document"),
    ],
)
def test_documents_that_are_errors(spark, tmp_path, text, message):
    path = landed(tmp_path / "feed", [text])
    for size in (5, 1 << 20):
        with pytest.raises(Exception, match=message):
            in_ranges(spark, path, size)


def test_one_large_document_is_read_by_many_tasks(spark, tmp_path):
    """A single line of 210 MB; no task gets more than a range of 16 MB, and no row holds more than an order."""
    (tmp_path / "feed").mkdir()
    n, pad = 216_000, "x" * 940
    with open(tmp_path / "feed" / "big.json", "w") as out:
        out.write('{"CODE":"}","DATA":[')
        for i in range(n):
            out.write(f'{"," if i else ""}{{"AUFNR":"{i}","MAKTX":"{pad}","SUB":{{"i":[{{}}]}}}}')
        out.write("]}")
    assert (tmp_path / "feed" / "big.json").stat().st_size > 200 << 20
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(16 << 20))
    try:
        from reportloom.sources.structure import json_pieces

        ranges = json_pieces(spark, str(tmp_path / "feed")).groupBy("__block").agg(F.max(F.length("__text")).alias("longest")).collect()
        assert len(ranges) >= 13 and max(r.longest for r in ranges) < 1100
        orders = read_feed(spark, str(tmp_path / "feed"), FIELDS)
        got = orders.agg(F.count("*"), F.sum(F.col("AUFNR").cast("long")), F.count_if(F.col("AUFNR").cast("int") == F.col("__pos")), F.max(F.length("MAKTX"))).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert tuple(got) == (n, n * (n - 1) // 2, n, len(pad))


def test_groups_read_and_shuffle_texts_once(spark, tmp_path, monkeypatch):
    """The sums over byte ranges and files are stored before; nothing sums them up again beside the texts."""
    plans = []
    stored = structure.materialise
    monkeypatch.setattr(structure, "materialise", lambda df: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), stored(df))[1])
    path = landed(tmp_path / "in", TRICKY)
    assert structure.json_groups(spark, path).count() > len(TRICKY)
    assert len(re.findall(r"Relation \[.*\] text", plans[-1])) == 1


def test_payloads_get_their_day_without_a_join(spark):
    payloads = tables_in_out.dated_payloads(spark, "/root/testdata/sf0.001")
    assert "Join" not in payloads._jdf.queryExecution().optimizedPlan().toString()
    assert payloads.columns == ["event_id", "DATA", "day"]
