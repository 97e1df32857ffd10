"""Form cells to columns, JSON documents to rows, rows to records."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def composite_attribute(name: Column, child: Column) -> Column:
    """`name-child` if the child name is not empty, else `name`; a null child counts as empty."""
    return F.when(F.length(child) > 0, F.concat_ws("-", name, child)).otherwise(name)


def pivot_attributes(
    cells: DataFrame,
    key: str | Sequence[str],
    attributes: Sequence[str],
    name: Column | str = "name",
    value: str = "value",
    ignore: Sequence[str] = (),
) -> DataFrame:
    """One row per key with a column per declared attribute; a repeated or an undeclared attribute raises an error.

    Cells whose attribute is in `ignore`, or null, are left out. Conditional aggregates combine before the shuffle and keep one value per attribute, so the state of a key
    is bounded however many cells it has.
    """
    keys = [key] if isinstance(key, str) else list(key)
    name = F.col(name) if isinstance(name, str) else name
    named = cells.select(*keys, name.alias("__name"), F.col(value).alias("__value"))
    wanted = named.where(~F.col("__name").isin(list(ignore)) if ignore else F.col("__name").isNotNull())
    aggregates = [F.max(F.when(~F.col("__name").isin(list(attributes)), F.col("__name"))).alias("__undeclared")]
    for i, attribute in enumerate(attributes):
        hit = F.col("__name") == attribute
        aggregates.append(F.max(F.when(hit, F.col("__value"))).alias(f"__v{i}"))
        aggregates.append(F.count_if(hit).alias(f"__n{i}"))
    message = F.concat(F.lit("undeclared attribute: "), F.col("__undeclared"))
    grouped = wanted.groupBy(*keys).agg(*aggregates).where(F.assert_true(F.col("__undeclared").isNull(), message).isNull())
    checked = [
        F.when(F.col(f"__n{i}") > 1, F.raise_error(F.lit(f"attribute '{a}' occurs more than once in a form")).cast("string"))
        .otherwise(F.col(f"__v{i}"))
        .alias(a)
        for i, a in enumerate(attributes)
    ]
    return grouped.select(*keys, *checked)


#: Attributes that forms may have if they are not declared. A column each; more of them are an error.
MOST_ATTRIBUTES = 1000


def found_attributes(cells: DataFrame, name: Column | str = "name", ignore: Sequence[str] = (), most: int = MOST_ATTRIBUTES) -> list[str]:
    """The attribute names that occur, sorted. A job of its own: each task and the shuffle hold different names only.

    At most `most` names and one more reach the driver; more than `most` are an error, so no attribute is lost.
    """
    name = F.col(name) if isinstance(name, str) else name
    names = cells.select(name.alias("name")).where("name IS NOT NULL")
    if ignore:
        names = names.where(~F.col("name").isin(list(ignore)))
    found = sorted(r.name for r in names.distinct().limit(most + 1).collect())
    if len(found) > most:
        raise ValueError(f"forms have more than {most} attributes; declare those wanted or raise the bound")
    return found


def pivot_found_attributes(
    cells: DataFrame,
    key: str | Sequence[str],
    name: Column | str = "name",
    value: str = "value",
    ignore: Sequence[str] = (),
    most: int = MOST_ATTRIBUTES,
) -> DataFrame:
    """One row per key with a column for every attribute that occurs, in order of their names; a repeated attribute raises an error.

    Cells are first counted per key and attribute, so one that repeats without end stays one row, and a key's map of
    attributes has at most as many entries as there are columns.
    """
    keys = [key] if isinstance(key, str) else list(key)
    name = F.col(name) if isinstance(name, str) else name
    found = found_attributes(cells, name, ignore, most)
    named = cells.select(*keys, name.alias("__name"), F.col(value).alias("__value")).where(F.col("__name").isNotNull())
    if ignore:
        named = named.where(~F.col("__name").isin(list(ignore)))
    counted = named.groupBy(*keys, "__name").agg(F.max("__value").alias("__value"), F.count(F.lit(1)).alias("__n"))
    repeated = F.concat(F.lit("attribute '"), F.col("__name"), F.lit("' occurs more than once in a form"))
    # With the count in it, the check is not pushed below a semi-join of the cells.
    known = F.col("__n") < 0 if not found else F.col("__name").isin(found) & (F.col("__n") > 0)
    late = F.concat(F.lit("attribute '"), F.col("__name"), F.lit("' came while the forms were read"))
    once = counted.where(F.assert_true(F.col("__n") == 1, repeated).isNull() & F.assert_true(known, late).isNull())
    maps = once.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("__name", "__value"))).alias("__cells"))
    return maps.select(*keys, *[F.col("__cells")[attribute].alias(attribute) for attribute in found])


def forms_with_attributes(
    header: DataFrame,
    cells: DataFrame,
    key: str,
    attributes: Sequence[str] | None = None,
    name: Column | str = "name",
    value: str = "value",
    ignore: Sequence[str] = (),
) -> DataFrame:
    """Header rows with their attributes as columns; a form without cells keeps its row with nulls.

    Without declared `attributes` there is a column for each one that the cells have, which a job looks up first.
    """
    if attributes is None:
        return header.join(pivot_found_attributes(cells, key, name, value, ignore), key, "left")
    return header.join(pivot_attributes(cells, key, attributes, name, value, ignore), key, "left")


def explode_documents(df: DataFrame, json_column: str, document: T.StructType | str) -> DataFrame:
    """One row per object of a JSON column that holds an object or a list of objects.

    An empty list or a null document gives no row, malformed JSON is an error. Nested objects become
    columns with dotted names.
    """
    struct = T.StructType.fromDDL(document) if isinstance(document, str) else document
    parsed = F.from_json(F.col(json_column), T.ArrayType(struct), {"mode": "FAILFAST"})
    others = [c for c in df.columns if c != json_column]
    rows = df.select(*others, F.explode(parsed).alias("__doc"))
    return rows.select(*others, *_flat_fields(struct, "__doc", ""))


def _flat_fields(struct: T.StructType, path: str, prefix: str) -> list[Column]:
    out = []
    for f in struct.fields:
        inner = f"{path}.`{f.name}`"
        if isinstance(f.dataType, T.StructType):
            out += _flat_fields(f.dataType, inner, f"{prefix}{f.name}.")
        else:
            out.append(F.col(inner).alias(f"{prefix}{f.name}"))
    return out


#: Columns that documents may have if their schema is not declared; more of them are an error.
MOST_COLUMNS = 1000


def _documents(df: DataFrame, json_column: str) -> DataFrame:
    """The other columns and `__doc`, a variant, for each object of a JSON column that holds an object or a list of objects."""
    others = [c for c in df.columns if c != json_column]
    parsed = df.select(*others, F.parse_json(F.col(json_column).cast("string")).alias("__doc")).where(F.col("__doc").isNotNull())
    listed = F.coalesce(F.try_variant_get("__doc", "$", "array<variant>"), F.array("__doc"))
    return parsed.select(*others, F.explode(listed).alias("__doc"))


def _unified(kind: T.DataType, path: str) -> T.DataType:
    """The column type for a type found in documents; `path` is for messages."""
    if isinstance(kind, T.VariantType):
        raise ValueError(f"documents have values of conflicting types at {path}")
    if isinstance(kind, T.NullType):
        return T.StringType()
    if isinstance(kind, T.FloatType) or isinstance(kind, T.DecimalType) and kind.scale:
        return T.DoubleType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_unified(kind.elementType, f"{path}[]"))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _unified(f.dataType, f"{path}.{f.name}")) for f in kind.fields])
    return kind


def found_schema(df: DataFrame, json_column: str, most: int = MOST_COLUMNS) -> T.StructType:
    """The union of all paths in the documents of a JSON column, with their types: one distributed aggregate, merged like a sum.

    Whole numbers and fractions give a double, a path that is always null a text. Other differing types at one path, documents
    that are no objects, and more than `most` columns are errors. Only the schema reaches the driver.
    """
    text = _documents(df, json_column).agg(F.schema_of_variant_agg("__doc")).first()[0]
    kind = T.DataType.fromDDL(re.sub(r"`(?:[^`]|``)*`|\bOBJECT<", lambda m: "STRUCT<" if m.group() == "OBJECT<" else m.group(), text))
    if isinstance(kind, T.NullType):
        return T.StructType()
    if not isinstance(kind, T.StructType):
        raise ValueError(f"documents of {json_column} are not all objects")
    schema = _unified(kind, json_column)
    count = sum(1 for _ in _leaves(schema))
    if count > most:
        raise ValueError(f"documents of {json_column} have {count} columns, more than {most}; declare their schema or raise the bound")
    return schema


def _leaves(struct: T.StructType, path: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], T.DataType]]:
    for f in struct.fields:
        if isinstance(f.dataType, T.StructType):
            yield from _leaves(f.dataType, (*path, f.name))
        else:
            yield (*path, f.name), f.dataType


def _variant_path(path: Sequence[str]) -> str:
    steps = []
    for key in path:
        quote = next((q for q in "\"'" if key and q not in key), None)
        if quote is None:
            raise ValueError(f"the key {key!r} of a document can't be addressed")
        steps.append(f"[{quote}{key}{quote}]")
    return "$" + "".join(steps)


def normalised_documents(df: DataFrame, json_column: str, schema: T.StructType | None = None) -> DataFrame:
    """One row per object of a JSON column, with a column for each path that any document has; nested names are dotted.

    The schema is found by a job of its own (`found_schema`) unless it is given. An empty list or a null document gives no row, malformed JSON
    and a null in a list are errors, lists within a document stay lists, and an empty object gives no column.
    """
    schema = found_schema(df, json_column) if schema is None else schema
    others = [c for c in df.columns if c != json_column]
    columns = {".".join(path): (path, kind) for path, kind in _leaves(schema)}
    if len(columns) < sum(1 for _ in _leaves(schema)) or set(columns) & set(others):
        raise ValueError(f"two columns of the documents, or one of them and another column, have the same name: {sorted(columns)}")
    rows = _documents(df, json_column).where(F.assert_true(~F.is_variant_null("__doc"), "a document is null").isNull())
    values = [F.variant_get("__doc", _variant_path(path), kind.simpleString()).alias(name) for name, (path, kind) in columns.items()]
    return rows.select(*[F.col(f"`{c}`") for c in others], *values)


def to_records(df: DataFrame, keys: Sequence[str] = (), name: str = "record") -> DataFrame:
    """Each row as a JSON record with nulls kept and timestamps as readable text."""
    options = {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss", "timestampFormat": "yyyy-MM-dd HH:mm:ss"}
    body = F.to_json(F.struct(*[c for c in df.columns if c not in keys]), options)
    return df.select(*keys, body.alias(name))


def with_sentinel_row(df: DataFrame, values: Mapping[str, object], probe: DataFrame | None = None) -> DataFrame:
    """The frame, or one row that only has `values` if the frame is empty.

    `probe` may give a cheaper frame that is empty exactly when `df` is; only its first row is looked for.
    """
    sentinel = df.sparkSession.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    first = (df if probe is None else probe).select(F.lit(1).alias("__any")).limit(1)
    lonely = sentinel.join(first, F.lit(True), "left_anti")
    return df.unionByName(lonely, allowMissingColumns=True)


def stack_sheets(sheets: Mapping[str, DataFrame], name: str = "sheet_name") -> DataFrame:
    """Frames of one book under each other with their sheet name; absent columns are null."""
    parts = [df.withColumn(name, F.lit(title)) for title, df in sheets.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out
