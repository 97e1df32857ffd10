"""Shared parts: reading `documents`, batch-wise Arrow steps, and tables written between steps."""

from __future__ import annotations

import ctypes
import hashlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Rows of an Arrow batch. Texts may be long, so a batch is kept small; each kernel cuts it further by bytes.
BATCH_ROWS = 500
_shipped: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Keep Arrow batches small: the default of 10,000 rows may be more than a worker's memory when texts are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    _ship_package(spark)
    return spark


def _ship_package(spark: SparkSession) -> None:
    """Python workers import this package: where their path lacks it, Spark sends it to them, once for each context."""
    root = Path(__file__).resolve().parents[2]
    context = spark.sparkContext
    on_path = {str(Path(p).resolve()) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    if str(root) in on_path or context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="reportloom-code-")) / "reportloom.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted((root / "reportloom").rglob("*.py")):
            out.write(path, path.relative_to(root))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """`doc_id`, `text` (null: empty) and the columns named, whatever else `docs` has."""
    prepare(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *(F.col(name) for name in more),
    )


def text_key(text: Column) -> Column:
    """Tells the texts of rows with one `doc_id` apart."""
    return F.xxhash64(text)


@cache
def _libc() -> ctypes.CDLL | None:
    libc = ctypes.CDLL(None)
    return libc if hasattr(libc, "malloc_trim") else None


def give_back() -> None:
    """Return freed memory to the system. Python workers stay for later tasks, and with what their allocators keep of the largest
    one so far an executor would need room for the largest steps of all queries at once."""
    pa.default_memory_pool().release_unused()
    if libc := _libc():
        libc.malloc_trim(0)


def task_step(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    """Apply `run` to the record batches of each task; the worker keeps no memory of it."""

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(lean, schema)


def arrow_step(df: DataFrame, step: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    """Apply `step` to each record batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from step(batch)

    return task_step(df, run, schema)


def shared_folder(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`. Only where it is unset (tests on one machine) a local one is made and set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir is not set")
        folder = f"file://{tempfile.mkdtemp(prefix='reportloom-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the shared folder: computed once, and lost executors don't take it along.

    Keys aggregated for a join are written as well: with an aggregate right below it, adaptive execution could not split
    the join's hot keys.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bits of the map behind `maybe_among`: 2 MB, whatever the number of keys.
KEY_BITS = 1 << 24


def maybe_among(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows whose hash in `column` is in the first column of `keys`, and a few others, so that the others are not shuffled for a join.

    The keys' bits are set in a map of a fixed size, which is all that the driver and the tasks get; more keys make it less selective.
    """
    place = F.pmod(F.col(keys.columns[0]), F.lit(KEY_BITS))
    words = keys.select(place.alias("place")).selectExpr("cast(place div 64 as int) AS word", "shiftleft(1L, cast(place % 64 as int)) AS bit")
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(KEY_BITS // 64, np.uint64)
    bits[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    shared = df.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def among(hashes: pd.Series) -> pd.Series:
        at = hashes.to_numpy() % KEY_BITS
        return pd.Series((shared.value[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1) > 0)

    return df.where(among(F.col(column)))


def sha256_text(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()
