"""Runs queries and their SQL counterparts and compares the results.

    python tests/compare.py [--sf 0.01] [name or prefix ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def database(folder: str):
    con = duckdb.connect()
    con.execute("SET threads TO 4")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def cell(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return repr(v)


def rows_of(table, names):
    data = table.to_pydict()
    return sorted(tuple(map(cell, r)) for r in zip(*[data[n] for n in names]))


def simple(kind) -> str:
    text = str(kind)
    return "string" if text == "large_string" else text


def compare(spark, con, name, query, sql, folder):
    """None when both results agree, else what differs."""
    ours = query(spark, folder).toArrow()
    theirs = con.sql(sql).to_arrow_table()
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return f"columns {ours.column_names} / {theirs.column_names}"
    names = sorted(ours.column_names)
    for n in names:
        a, b = simple(ours.schema.field(n).type), simple(theirs.schema.field(n).type)
        if a != b:
            return f"type of {n}: {a} / {b}"
    if ours.num_rows != theirs.num_rows:
        return f"rows {ours.num_rows} / {theirs.num_rows}"
    if ours.num_rows == 0:
        return "no rows"
    mine, other = rows_of(ours, names), rows_of(theirs, names)
    if mine != other:
        differing = [(x, y) for x, y in zip(mine, other) if x != y]
        return f"{len(differing)} rows differ, first {names} {differing[0]}"
    return None


def main():
    from conftest import make_session

    import __spark_entry__ as e

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    spark, con = make_session(), database(folder)
    queries, oracles = e.queries(), e.oracle_sql()
    chosen = [
        n for n in queries if not args.names or any(n == a or n.startswith(a) for a in args.names)
    ]
    bad = 0
    for n in chosen:
        start = time.time()
        try:
            if n in oracles:
                result = compare(spark, con, n, queries[n], oracles[n], folder)
            else:
                count = queries[n](spark, folder).count()
                result = None if count else "no rows"
        except Exception as error:
            result = f"{type(error).__name__}: {str(error)[:600]}"
        took = time.time() - start
        if result or took > 4:
            print(f"{'FAIL' if result else 'ok  '} {n} {took:.1f}s {result or ''}", flush=True)
        bad += bool(result)
    print(f"{len(chosen) - bad} of {len(chosen)} agree")
    return bad


if __name__ == "__main__":
    raise SystemExit(1 if main() else 0)
