"""Compare a Spark result with its DuckDB twin: columns by name, rows in any order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return None if value is None else str(value)


def _canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cells = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(names), sorted(cells, key=lambda r: tuple((c is None, c or "") for c in r))


def compare(df, con, sql):
    spark_names, spark_rows = _canonical(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    duck_names, duck_rows = _canonical([c[0] for c in result.description], result.fetchall())
    assert spark_names == duck_names, f"columns {spark_names} != {duck_names}"
    assert len(spark_rows) == len(duck_rows), f"rows {len(spark_rows)} != {len(duck_rows)}"
    for ours, theirs in zip(spark_rows, duck_rows):
        assert ours == theirs, f"{ours} != {theirs}"
    return len(spark_rows)
