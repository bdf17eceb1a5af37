"""Run registered queries on Spark and their SQL on DuckDB and compare every value."""

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb

from marginfold.verify.oracle import oracle_sql
from marginfold.verify.queries import queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _key(row):
    return tuple((v is None, str(type(v).__name__), v if v is not None else 0) for v in row)


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return type(a) is type(b) and a == b


def compare(spark, con, name, folder):
    """None when equal, else a description of the first difference."""
    return compare_results(queries()[name](spark, folder), con, oracle_sql()[name])


def compare_results(frame, con, sql):
    """None when a frame has the rows of a DuckDB query, else a description of the first difference."""
    columns = sorted(frame.columns)
    got = [tuple(r[c] for c in columns) for r in frame.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns differ: {set(names) ^ set(columns)}"
    order = [names.index(c) for c in columns]
    want = [tuple(r[i] for i in order) for r in result.fetchall()]
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for g, w in zip(sorted(got, key=_key), sorted(want, key=_key)):
        for c, a, b in zip(columns, g, w):
            if not _same(a, b):
                return f"{c}: {a!r} != {b!r}\n  got  {g}\n  want {w}"
    return None


if __name__ == "__main__":
    from conftest import make_spark

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(queries())
    spark, con = make_spark(), connect(folder)
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            diff = compare(spark, con, name, folder)
        except Exception as exc:
            diff = f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'DIFF'} {time.time() - start:6.2f}s {name} {diff or ''}", flush=True)
    print(f"{len(wanted) - bad}/{len(wanted)} match")
