"""Run registered queries on Spark and their SQL on DuckDB and compare all values."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (bytearray, memoryview)):
        return repr(bytes(value))
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    """Empty when names and all values agree."""
    cur = con.execute(sql)
    names, expected = _rows([d[0] for d in cur.description], cur.fetchall())
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if names != got_names:
        return [f"columns {got_names} != {names}"]
    if len(got) != len(expected):
        extra = sorted(set(got) - set(expected))[:2]
        missing = sorted(set(expected) - set(got))[:2]
        return [f"rows {len(got)} != {len(expected)}; spark only {extra}; sql only {missing}"]
    for g, e in zip(got, expected):
        if g != e:
            return [f"{names}: {g} != {e}"]
    return []


if __name__ == "__main__":
    from obsledger.session import local_session

    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = local_session(8)
    con = connect(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not args or any(n.startswith(a) for a in args)]
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in oracles:
                problems = differences(queries[name](spark, sf), con, oracles[name])
            else:
                problems = [] if queries[name](spark, sf).count() else ["no rows"]
        except Exception as exc:  # report and go on with the next query
            problems = [f"{type(exc).__name__}: {str(exc)[:600]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok'} {name} {time.time() - start:.1f}s {problems[0] if problems else ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
