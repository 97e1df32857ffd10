"""Compare a Spark result with DuckDB on the same files, as multisets of rows by column name."""

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(base):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(base, name)}.parquet'")
    return db


def _plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if hasattr(value, "to_pydatetime"):
        return value.to_pydatetime()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(db, sql):
    cursor = db.execute(sql)
    return _rows([c[0] for c in cursor.description], cursor.fetchall())


def spark_types(df):
    """Column types in DuckDB's words."""
    words = {
        "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
        "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
    }
    return {name: words.get(kind, kind) for name, kind in df.dtypes}


def duck_types(db, sql):
    return {c[0]: str(c[1]) for c in db.execute(sql).description}
