"""Projection helpers over whole frames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportloom.functions.text import display


def rename_fields(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that are present; absent ones are ignored."""
    return df.withColumnsRenamed(dict(names))


def underscore_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.replace(" ", "_") for c in df.columns])


def with_header(df: DataFrame, header: Mapping[str, Column], prefix: str = "") -> DataFrame:
    """Header values on every row; `prefix` keeps them apart from columns of the same name."""
    named = {f"{prefix}{k}": v for k, v in header.items()}
    taken = sorted(set(named) & set(df.columns))
    if taken:
        raise ValueError(f"header values would replace columns: {taken}")
    return df.withColumns(named)


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def sentinel_to_null(df: DataFrame, sentinel: str = "0000-00-00") -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit(sentinel)) for c in text_columns(df)})


def fill_all_as_text(df: DataFrame, filler: str = "--", keep: Iterable[str] = ()) -> DataFrame:
    """Every column as text with nulls shown as `filler`; columns in `keep` stay typed."""
    kept = set(keep)
    return df.select(*[F.col(c) if c in kept else display(F.col(c), filler).alias(c) for c in df.columns])
