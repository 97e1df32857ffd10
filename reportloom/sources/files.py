"""Choice of input files by modification time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_listing(spark: SparkSession, pattern: str) -> DataFrame:
    """Path, name and modification time of the files that match; contents are not read."""
    listing = spark.read.format("binaryFile").load(pattern)
    return listing.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "modificationTime")


def newest_file(listing: DataFrame) -> DataFrame:
    """The newest file whose name does not start with `~`; equal times are settled by the path."""
    usable = listing.where(~F.col("file_name").startswith("~"))
    return usable.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path"))


def last_file(spark: SparkSession, pattern: str) -> str:
    path = newest_file(file_listing(spark, pattern)).first()["path"]
    if path is None:
        raise FileNotFoundError(f"no file matches {pattern}")
    return path
