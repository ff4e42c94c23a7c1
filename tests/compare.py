"""Run registered queries next to their oracle SQL and compare rows, names and kinds.

    python -m tests.compare --dir /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time

import duckdb

from quoteloom.session import get_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

_KIND = {
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "integer": "int", "hugeint": "int",
    "double": "float", "float": "float", "string": "text", "varchar": "text", "boolean": "bool",
    "date": "date", "timestamp": "timestamp", "timestamp_ntz": "timestamp",
}


def kind(name: str) -> str:
    return _KIND.get(str(name).lower(), str(name).lower())


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def oracle_rows(con, sql: str):
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    kinds = [kind(c[1]) for c in cur.description]
    return names, kinds, cur.fetchall()


def cell(v) -> str:
    if v is None:
        return "\x00null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    return str(v)


def compare(spark, con, sf_dir: str, fn, sql: str, may_be_empty: bool = False) -> list[str]:
    """Differences between a query and its oracle; empty when equal."""
    df = fn(spark, sf_dir)
    rows = df.collect()
    names, kinds, want = oracle_rows(con, sql)
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    have_kind = {n: kind(t) for n, t in df.dtypes}
    want_kind = dict(zip(names, kinds))
    for n in sorted(names):
        if have_kind[n] != want_kind[n]:
            problems.append(f"kind of {n}: {have_kind[n]} != {want_kind[n]}")
    order = sorted(names)
    at = [names.index(n) for n in order]
    a = sorted(tuple(cell(row[n]) for n in order) for row in rows)
    b = sorted(tuple(cell(row[i]) for i in at) for row in want)
    if len(a) != len(b):
        problems.append(f"rows {len(a)} != {len(b)}")
    if a != b:
        only_a, only_b = set(a) - set(b), set(b) - set(a)
        problems.append(f"{len(only_a)} rows differ, e.g. {order}: {sorted(only_a)[:2]} != {sorted(only_b)[:2]}")
    if not a and not may_be_empty:
        problems.append("no rows at all")
    return problems


def main() -> int:
    from checks import ORACLE, QUERIES

    parser = argparse.ArgumentParser()
    parser.add_argument("--dir", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = get_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.dir)
    bad = 0
    for name in args.names or QUERIES:
        begun = time.time()
        try:
            if name in ORACLE:
                found = compare(spark, con, args.dir, QUERIES[name], ORACLE[name])
            else:
                found = [] if QUERIES[name](spark, args.dir).collect() else ["no rows at all"]
        except Exception as exc:  # noqa: BLE001 - report and go on
            found = [f"{type(exc).__name__}: {str(exc)[:1500]}"]
        bad += bool(found)
        state = "BAD " if found else ("ok  " if name in ORACLE else "rows")
        print(f"{state} {name} {time.time() - begun:.1f}s", *found, sep="\n     " if found else " ", flush=True)
    print(f"{bad} bad of {len(args.names or QUERIES)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
