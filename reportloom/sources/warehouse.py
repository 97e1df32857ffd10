"""Warehouse tables as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(
    spark: SparkSession, base: str, name: str, fmt: str = "parquet", schema: StructType | None = None
) -> DataFrame:
    """A table stored as files under `base`; filters and column choice reach the scan.

    A known schema saves the job that reads it from the files.
    """
    suffix = f".{fmt}" if fmt == "parquet" else ""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(f"{base.rstrip('/')}/{name}{suffix}")


def read_database(
    spark: SparkSession,
    url: str,
    table: str,
    split_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    splits: int = 64,
    properties: dict[str, str] | None = None,
    one_task: bool = False,
    predicates: Sequence[str] = (),
) -> DataFrame:
    """A table behind JDBC, read in `splits` ranges of `split_column`; `one_task` allows a small table to be read whole.

    Ranges between two bounds have equal width. `predicates` gives a part per condition instead, such as the ranges of equal depth
    of `sources.ranges`.
    """
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=dict(properties or {}))
    if split_column is None and not one_task:
        raise ValueError("name a split column with its bounds, or allow one task to read the table")
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if split_column is not None:
        if bounds is None:
            raise ValueError("a split column needs its lower and upper bound")
        reader = (
            reader.option("partitionColumn", split_column)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", str(splits))
        )
    return reader.load()
