"""Run registered queries against their SQL in DuckDB and compare whole results.

As a script: python tests/oracle.py <scale folder> [query ...]
"""

from __future__ import annotations

import math
import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TESTDATA = pathlib.Path("/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _sortable(row: tuple) -> tuple:
    return tuple((value is None, str(type(value)), value if value is not None else 0) for value in row)


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(picked, key=_sortable)


def compare(spark, con, name: str, sf_dir: str) -> tuple[str, int]:
    """'' if both sides agree, else what differs; and the number of rows."""
    from workload import ORACLES, QUERIES

    df = QUERIES[name](spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    want = _rows(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got)
    if len(got) != len(want):
        return f"{len(got)} rows, oracle has {len(want)}", len(got)
    for left, right in zip(got, want):
        for a, b in zip(left, right):
            same = type(a) is type(b) and (a == b or (isinstance(a, float) and math.isnan(a) and math.isnan(b)))
            if not same:
                return f"{left} != {right}", len(got)
    return "", len(got)


def main() -> None:
    from marquee.session import build_session
    from workload import ORACLES

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(ORACLES)
    spark = build_session("local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        started = time.time()
        try:
            problem, count = compare(spark, con, name, sf_dir)
        except Exception as error:  # report every query, not only the first bad one
            problem, count = f"{type(error).__name__}: {str(error)[:1500]}", -1
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} rows={count} {time.time() - started:.1f}s {problem[:1800]}", flush=True)
    print(f"{len(names) - bad}/{len(names)} agree")


if __name__ == "__main__":
    main()
