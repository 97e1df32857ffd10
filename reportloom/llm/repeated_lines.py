"""Line deduplication with overlapping windows of three lines.

Lines without a word stay and take no part. Over the other lines of each document, each three consecutive ones are a window.
A window that also occurs earlier (smaller doc_id, then further up) is a repeat, and all lines that repeats cover go. DataFrame
operations only; a window is two 64-bit hashes of its lines, so no text is shuffled until the kept lines are put together.

Cases: a null text is empty; a document of fewer than three lines with words is never changed; rows that agree in doc_id and
text are one document and are treated alike; a null doc_id comes after all others; an empty table gives an empty result;
further columns are kept as they are, whatever their names.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from .common import text_key, texts, written

WINDOW_LINES = 3
SPACES = " \t\n\x0b\f\r"


def _windows(docs: DataFrame) -> DataFrame:
    """`doc_id`, `key`, the raw positions `at` of the lines of each window, and its hashes."""
    lines = texts(docs).select("doc_id", text_key(F.col("text")).alias("key"), F.split("text", "\n", -1).alias("raw"))
    filled = lines.select(
        "doc_id",
        "key",
        F.filter(F.transform("raw", lambda line, i: F.struct(i.alias("i"), line.alias("line"))), lambda x: F.btrim(x["line"], F.lit(SPACES)) != "").alias("filled"),
    ).where(F.size("filled") >= WINDOW_LINES)

    def window(j):
        three = [F.get("filled", j + k) for k in range(WINDOW_LINES)]
        own = [x["line"] for x in three]
        return F.struct(
            F.array(*(x["i"] for x in three)).alias("at"),
            F.xxhash64(*own).alias("a"),
            F.xxhash64(F.lit("second"), *own).alias("b"),
        )

    each = filled.select("doc_id", "key", F.explode(F.transform(F.sequence(F.lit(0), F.size("filled") - WINDOW_LINES), window)).alias("w"))
    return each.select("doc_id", "key", F.col("w.at").alias("at"), F.col("w.a").alias("a"), F.col("w.b").alias("b"))


def repeated_lines(docs: DataFrame) -> DataFrame:
    """`doc_id`, `key` (of the text) and the positions of the lines that go, for documents with any."""
    windows = _windows(docs).select(
        "a", "b", F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("key"), F.col("at")).alias("place")
    )
    first = windows.groupBy("a", "b").agg(F.min("place").alias("first"), F.max("place").alias("last")).where("first <> last").select("a", "b", "first")
    first = written(first, "repeated-windows")
    later = windows.join(first, ["a", "b"]).where(F.col("place") != F.col("first"))
    return (
        later.select("place.doc_id", "place.key", F.explode("place.at").alias("line"))
        .groupBy("doc_id", "key")
        .agg(F.collect_set("line").alias("lines"))
    )


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """Columns `doc` (the row of `docs` with its kept text), `n_lines` (lines with a word) and `n_removed`."""
    gone = repeated_lines(docs).select(F.col("doc_id").alias("gone_id"), F.col("key").alias("gone_key"), "lines")
    text = F.coalesce(F.col("doc.text").cast("string"), F.lit(""))
    rows = docs.select(F.struct("*").alias("doc")).withColumn("key", text_key(text))
    joined = rows.join(gone, F.col("doc.doc_id").cast("long").eqNullSafe(F.col("gone_id")) & (F.col("key") == F.col("gone_key")), "left")
    split = joined.select("doc", F.split(text, "\n", -1).alias("raw"), "lines")
    kept = F.array_except(F.sequence(F.lit(0), F.size("raw") - 1), F.col("lines"))
    kept_text = F.when(F.col("lines").isNull(), F.col("doc.text")).otherwise(F.array_join(F.transform(kept, lambda i: F.get("raw", i)), "\n"))
    filled = F.filter("raw", lambda line: F.btrim(line, F.lit(SPACES)) != "")
    return split.select(
        F.col("doc").withField("text", kept_text).alias("doc"),
        F.size(filled).cast("long").alias("n_lines"),
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_removed"),
    )
