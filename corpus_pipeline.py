"""The training-data pipeline: each stage takes the documents that its predecessor kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from reportloom.llm.common import prepare, shared_folder, table
from reportloom.llm.decontamination import without_contaminated
from reportloom.llm.near_duplicates import one_of_each
from reportloom.llm.pieces import encoded
from reportloom.llm.queries import PIECE_MODEL, tokenizer_path
from reportloom.llm.repeated_lines import without_repeated_lines
from reportloom.llm.toxicity import without_toxic

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't take for toxic."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that earlier documents have; documents of which nothing is left go. `n_chars` follows the text."""
    prepare(spark)
    kept = without_repeated_lines(docs).where("n_removed = 0 or n_removed < n_lines").select("doc.*", "n_removed")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        kept = kept.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    prepare(spark)
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, re-parameterised ones included."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and the text that they decode to."""
    prepare(spark)
    result = encoded(docs, tokenizer_path(PIECE_MODEL), "lang", "source")
    return result.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), "text")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentence_pieces", sentence_pieces),
]

#: A trained classifier, similarity classes and tokens are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other; each result is a table in the shared folder, from which the next one starts."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        result = stage(spark, docs, sf_dir)
        result.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(result.schema).parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
