"""Compare a Spark result with its SQL twin, regardless of row order."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (int, float)):
        return None if isinstance(value, float) and math.isnan(value) else float(value)
    return str(value)


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i].lower())
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(cells, key=lambda r: tuple((v is not None, str(type(v)), v if v is not None else 0) for v in r))


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both agree exactly, else a short description."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(n.lower() for n in names) != sorted(c.lower() for c in df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    expected = _rows(names, result.fetchall())
    got = _rows(df.columns, df.collect())
    if len(got) != len(expected):
        return f"rows {len(got)} vs {len(expected)}"
    bad = [(g, e) for g, e in zip(got, expected) if g != e]
    return f"{len(bad)} of {len(got)} rows differ, first: {bad[0][0]} vs {bad[0][1]}" if bad else None
