"""Side-by-side runs of a named query in Spark and its SQL counterpart in DuckDB."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def plain(value):
    """A value in a form both engines agree on."""
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    found = [tuple(plain(r[i]) for i in order) for r in values]
    return [columns[i] for i in order], sorted(found, key=repr)


def spark_rows(frame):
    return rows(frame.columns, [tuple(r) for r in frame.collect()])


def duck_rows(con, sql):
    result = con.execute(sql)
    return rows([d[0] for d in result.description], result.fetchall())


def difference(got, expected) -> str:
    """Empty if both sides agree, otherwise a short account of where they do not."""
    if got[0] != expected[0]:
        return f"columns {got[0]} != {expected[0]}"
    if len(got[1]) != len(expected[1]):
        return f"{len(got[1])} rows != {len(expected[1])}"
    for a, b in zip(got[1], expected[1], strict=True):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{str(a)[:300]} != {str(b)[:300]}"
    return ""


def main(sf: str, names: list[str]) -> None:
    """Compare the named queries, or all of them, and print what differs."""
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from conftest import session

    from firmlens.plans import ORACLES, QUERIES

    spark, con, bad = session(), connect(sf), 0
    for name in names or sorted(QUERIES):
        start = time.time()
        try:
            got = spark_rows(QUERIES[name](spark, sf))
            spent = time.time() - start
            note = difference(got, duck_rows(con, ORACLES[name])) if name in ORACLES else f"rows only: {len(got[1])}"
        except Exception as error:  # report and go on with the next query
            spent, note = time.time() - start, f"ERROR {str(error)[:600]}"
        bad += bool(note) and not note.startswith("rows only")
        print(f"{name:28s} {spent:6.2f}s {len(got[1]):7d} {note or 'ok'}", flush=True)
    print("different:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
