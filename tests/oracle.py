"""Compare a registered query with its SQL on DuckDB over the same files."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark_df, con, sql):
    """None if both hold the same columns and rows, else a short description."""
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    want = rows_of(names, relation.fetchall())
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if want == got:
        return None
    return (
        f"rows {sum(got.values())} vs {sum(want.values())}; "
        f"only spark {list((got - want).items())[:3]}; only sql {list((want - got).items())[:3]}"
    )
