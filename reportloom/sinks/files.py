"""Report output, appended tables, and the snapshots behind the work-order load."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.operators.keys import upsert_into_clean, upsert_latest
from reportloom.operators.rollup import counted

POSITION = "report_position"


def write_report(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), mode: str = "error") -> int:
    """Write a report and return its number of rows; `partition_by` gives one folder per sheet, region or report date.

    Rows are rebalanced over the folders: Spark splits a large folder over tasks and joins small ones. The order of the report
    is kept in a column `report_position` (rising, with gaps), and each file is sorted by it.
    """
    if not partition_by:
        seen, rows = counted(df, f"report-{uuid.uuid4().hex}")
        seen.write.format(fmt).mode(mode).save(path)
        return rows.get["rows"]
    # The position stands between the report's sort and the rebalancing, so the sort is not dropped as useless.
    seen, rows = counted(df.withColumn(POSITION, F.monotonically_increasing_id()), f"report-{uuid.uuid4().hex}")
    placed = seen.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, POSITION)
    placed.write.format(fmt).mode(mode).partitionBy(*partition_by).save(path)
    return rows.get["rows"]


def append_rows(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("append").save(path)


PERIOD = "period"


def write_by_month(df: DataFrame, path: str, day: str, mode: str = "error") -> None:
    """Write facts in a folder per month of `day` (column `period`, the first of the month)."""
    placed = df.withColumn(PERIOD, F.trunc(F.col(day).cast("date"), "MM"))
    placed.hint("rebalance", PERIOD).write.mode(mode).partitionBy(PERIOD).parquet(path)


def facts_of_days(facts: DataFrame, days: DataFrame, day: str) -> DataFrame:
    """Facts written by month whose day is in `days`. Only the months of those days are read: Spark looks them up first and prunes
    the folders with them (dynamic partition pruning)."""
    wanted = days.select(F.col(day).cast("date").alias("__day")).distinct().withColumn("__period", F.trunc("__day", "MM"))
    joined = facts.join(wanted, (F.col(PERIOD) == F.col("__period")) & (F.col(day).cast("date") == F.col("__day")), "left_semi")
    return joined.drop(PERIOD)


class Stored(NamedTuple):
    """A snapshot of a table, and its rows."""

    snapshot: int
    rows: int


def _snapshot_folder(table: str, number: int) -> str:
    return f"{table.rstrip('/')}/snapshot={number:08d}"


def newest_snapshot(spark: SparkSession, table: str) -> int | None:
    """The number of the last complete snapshot under `table`; a write that failed has no success file and doesn't count."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table.rstrip('/')}/snapshot=*/_SUCCESS")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or []
    return max((int(status.getPath().getParent().getName().removeprefix("snapshot=")) for status in found), default=None)


def read_snapshot(spark: SparkSession, table: str, number: int | None = None) -> DataFrame:
    """A snapshot of a table, by default the newest."""
    number = newest_snapshot(spark, table) if number is None else number
    if number is None:
        raise FileNotFoundError(f"no snapshot under {table}")
    return spark.read.parquet(_snapshot_folder(table, number))


def store_latest(spark: SparkSession, table: str, batch: DataFrame, key: str, order: str) -> Stored:
    """Write the next snapshot: the latest rows per key of the newest one and the batch; rows without a key go.

    Readers of the old snapshot are not disturbed, and a load that fails leaves it in force. Rows whose key the batch doesn't have are copied without a
    shuffle. Where the cluster has a table format with `MERGE INTO`, that does the same and leaves untouched files in place.
    """
    last = newest_snapshot(spark, table)
    if last is None:
        rows = upsert_latest(batch.limit(0), batch, key, order)
    else:
        rows = upsert_into_clean(read_snapshot(spark, table, last), batch, key, order)
    number = (last or 0) + 1
    seen, count = counted(rows, f"snapshot-{uuid.uuid4().hex}")
    seen.write.mode("overwrite").parquet(_snapshot_folder(table, number))
    return Stored(number, count.get["rows"])
