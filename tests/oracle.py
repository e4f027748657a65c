"""Compare a Spark result with DuckDB's on the same tables, without regard to row order."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            db.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, list):
        return tuple(map(_plain, value))
    return value


def _rows(table) -> tuple[list[str], list[str], Counter]:
    names = sorted(table.column_names)
    table = table.select(names)
    kinds = [str(table.schema.field(n).type).replace("large_", "") for n in names]
    columns = [[_plain(v) for v in table.column(n).to_pylist()] for n in names]
    return names, kinds, Counter(zip(*columns))


def compare(spark_df, db: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty text when equal, else what differs."""
    got_names, got_kinds, got = _rows(spark_df.toArrow())
    result = db.sql(sql).arrow()
    result = result.read_all() if hasattr(result, "read_all") else result
    want_names, want_kinds, want = _rows(result)
    if got_names != want_names:
        return f"columns {got_names} instead of {want_names}"
    if got_kinds != want_kinds:
        return f"types {got_kinds} instead of {want_kinds} for {got_names}"
    if got != want:
        extra, missing = list((got - want).items())[:3], list((want - got).items())[:3]
        return f"{sum(got.values())} rows instead of {sum(want.values())}; extra {extra}; missing {missing}"
    if not got:
        return "no rows"
    return ""
