"""Compare a Spark result with DuckDB's, regardless of row order."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if v is None:
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    return str(v)


def spark_rows(df):
    table = df.toArrow()
    names = sorted(table.column_names)
    return names, _rows(table, names)


def duck_rows(con, sql):
    table = con.execute(sql).to_arrow_table()
    names = sorted(table.column_names)
    return names, _rows(table, names)


def _rows(table, names):
    columns = [[_cell(v) for v in table.column(n).to_pylist()] for n in names]
    return sorted(zip(*columns))


def difference(df, con, sql) -> str | None:
    """None when equal, else a short description."""
    got_names, got = spark_rows(df)
    want_names, want = duck_rows(con, sql)
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            wrong = sum(x != y for x, y in zip(got, want))
            return f"{wrong} rows differ, first: {dict(zip(got_names, a))} != {dict(zip(got_names, b))}"
    return None
