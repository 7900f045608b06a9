"""Compare a Spark result with a DuckDB result, independent of row and column order."""

import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return db


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return sorted(df.columns), _rows(df.columns, df.collect())


def sql_rows(db, sql):
    found = db.execute(sql)
    names = [d[0] for d in found.description]
    return sorted(names), _rows(names, found.fetchall())
