"""Run a registered query and its SQL twin, and compare them cell by cell."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, float):
        if math.isnan(value):
            return (2, "nan")
        return (2, repr(value))
    return (3, str(value))


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(tuple(_cell(row[name]) for name in names) for row in df.collect())


def duck_rows(con, sql):
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    names = sorted(columns)
    place = {name: columns.index(name) for name in names}
    return names, sorted(tuple(_cell(row[place[name]]) for name in names) for row in cursor.fetchall())


def difference(df, con, sql) -> str | None:
    """What differs, or None when schema and all values agree."""
    left_names, left = spark_rows(df)
    right_names, right = duck_rows(con, sql)
    if left_names != right_names:
        return f"columns {left_names} != {right_names}"
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)} rows"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        a, b = wrong[0]
        cells = [(n, x[1], y[1]) for n, x, y in zip(left_names, a, b) if x != y]
        return f"{len(wrong)} of {len(left)} rows differ, first in {cells[:4]}"
    return None
