"""Row ids and latest-per-key."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from reportloom.operators.ordering import with_dense_index

# Fixed values of the id layout: epoch in ms, bits of worker and sequence, first usable sequence.
ID_EPOCH_MS = 1288834974657
WORKER_BITS = 6
SEQUENCE_BITS = 6
FIRST_SEQUENCE = 6


def with_snowflake_id(
    df: DataFrame, *order: Column | str, start_ms: int, worker: int = 0, epoch_ms: int = ID_EPOCH_MS, name: str = "id", key: Sequence[str] | None = None
) -> DataFrame:
    """Time-ordered 64-bit ids in the order of a unique key: ms since the epoch, worker, sequence.

    A tick carries the sequences 6..63, so the dense row index alone fixes tick and sequence.
    """
    if not 0 <= worker < 1 << WORKER_BITS:
        raise ValueError(f"worker must be in 0..{(1 << WORKER_BITS) - 1}")
    per_tick = (1 << SEQUENCE_BITS) - FIRST_SEQUENCE
    indexed = with_dense_index(df, *order, name="__row", key=key)
    tick = F.lit(start_ms - epoch_ms) + F.floor(F.col("__row") / per_tick)
    sequence = F.lit(FIRST_SEQUENCE) + F.col("__row") % per_tick
    head = F.shiftleft(tick.cast("bigint"), WORKER_BITS + SEQUENCE_BITS)
    value = head.bitwiseOR(F.lit(worker << SEQUENCE_BITS).cast("bigint")).bitwiseOR(sequence.cast("bigint"))
    return indexed.withColumn(name, value).drop("__row")


def snowflake_parts(c: Column, epoch_ms: int = ID_EPOCH_MS) -> dict[str, Column]:
    """Decode an id into its time in ms, worker and sequence."""
    return {
        "time_ms": F.shiftright(c, WORKER_BITS + SEQUENCE_BITS) + F.lit(epoch_ms),
        "worker": F.shiftright(c, SEQUENCE_BITS).bitwiseAND(F.lit((1 << WORKER_BITS) - 1)),
        "sequence": c.bitwiseAND(F.lit((1 << SEQUENCE_BITS) - 1)),
    }


def with_load_id(
    df: DataFrame, *order: Column | str, now: datetime, digits: int = 12, name: str = "id", key: Sequence[str] | None = None
) -> DataFrame:
    """Text id of batch time and row index; the index is zero-padded so that text order is numeric order."""
    indexed = with_dense_index(df, *order, name="__row", key=key)
    index = F.col("__row").cast("string")
    too_long = F.raise_error(F.lit(f"a row index has more than {digits} digits")).cast("string")
    text = F.concat(F.lit(f"{now:%Y%m%d%H%M%S}"), F.when(F.length(index) <= digits, F.lpad(index, digits, "0")).otherwise(too_long))
    return indexed.withColumn(name, text).drop("__row")


def latest_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """Rows with the greatest `order` of their key; ties stay, null keys go.

    Spark turns `rank = 1` into a group limit before the shuffle, so a hot key sends its best rows per task only.
    """
    place = F.rank().over(W.partitionBy(key).orderBy(F.col(order).desc_nulls_last()))
    return df.where(F.col(key).isNotNull()).withColumn("__place", place).where("__place = 1").drop("__place")


def upsert_latest(existing: DataFrame, batch: DataFrame, key: str, order: str) -> DataFrame:
    """Append a batch and keep the latest rows per key; sending a batch twice changes nothing.

    The group limit comes first: only the best rows of a key are compared as whole rows.
    """
    return latest_per_key(existing.unionByName(batch, allowMissingColumns=True), key, order).dropDuplicates()


def upsert_into_clean(existing: DataFrame, batch: DataFrame, key: str, order: str) -> DataFrame:
    """`upsert_latest` for a table that is already its own result: only keys of the batch are worked on."""
    touched_keys = batch.where(F.col(key).isNotNull()).select(key).distinct()
    untouched = existing.join(touched_keys, key, "left_anti").where(F.col(key).isNotNull())
    touched = existing.join(touched_keys, key, "left_semi")
    return untouched.unionByName(upsert_latest(touched, batch, key, order), allowMissingColumns=True)
