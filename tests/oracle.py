"""Compare a registered query with its SQL on the same tables."""

from __future__ import annotations

import glob
import hashlib
import os

import duckdb


def connect(path: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in sorted(glob.glob(f"{path}/*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


def arrow_type(kind) -> str:
    text = str(kind).replace("large_", "")
    if text.startswith("timestamp"):
        return "timestamp"
    return text


def rows_of(table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, sorted(repr(r) for r in zip(*columns)) if columns else []


def compare(df, con, sql: str) -> list[str]:
    """Differences between a Spark result and the oracle's, empty when equal."""
    ours, theirs = df.toArrow(), con.sql(sql).to_arrow_table()
    names, a = rows_of(ours)
    other, b = rows_of(theirs)
    problems = []
    if names != other:
        return [f"columns {names} != {other}"]
    for n in names:
        x, y = arrow_type(ours.schema.field(n).type), arrow_type(theirs.schema.field(n).type)
        if x != y:
            problems.append(f"type of {n}: {x} != {y}")
    if len(a) != len(b):
        problems.append(f"rows {len(a)} != {len(b)}")
    if a != b:
        only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
        problems.append(f"values differ: ours {only_a} oracle {only_b}")
    if not a:
        problems.append("no rows")
    return problems


def digest(rows) -> str:
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()
