"""Comparison of a registered query with its SQL counterpart."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}") + 0.0
    return value


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def compare(spark_df, con, sql):
    """Returns (rows, list of differences)."""
    names = sorted(spark_df.columns)
    left = _sorted([tuple(_cell(r[n]) for n in names) for r in spark_df.collect()])
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != names:
        return len(left), [f"columns {names} != {sorted(columns)}"]
    at = [columns.index(n) for n in names]
    right = _sorted([tuple(_cell(r[i]) for i in at) for r in cursor.fetchall()])
    if len(left) != len(right):
        return len(left), [f"{len(left)} rows != {len(right)} rows"]
    return len(left), [f"{a} != {b}" for a, b in zip(left, right) if a != b]
