"""Run registered queries in Spark and in DuckDB and compare the rows."""

from __future__ import annotations

import math
import signal
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def tidy(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, (list, tuple)):
        return tuple(tidy(x) for x in v)
    if isinstance(v, dict):
        return tuple((k, tidy(x)) for k, x in sorted(v.items()))
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return sorted((tuple(tidy(r[n]) for n in order) for r in data), key=repr)


def compare(spark, con, fn, sql, sf_dir):
    """None when equal, otherwise what differs."""
    df = fn(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if df.columns else "no columns", len(got)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}", len(got)
    off = [(g, w) for g, w in zip(got, want) if g != w]
    if off:
        return f"{len(off)} rows differ, first {off[0]}", len(got)
    return None, len(got)


LIMIT_S = 90


def _too_long(*_):
    raise TimeoutError(f"more than {LIMIT_S} s")


def main(argv):
    signal.signal(signal.SIGALRM, _too_long)
    from sessionloom.session import local_session

    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.01"
    names = []
    for a in argv:
        if a.startswith("/"):
            sf = a
        else:
            names.append(a)
    spark = local_session(8)
    con = duck(sf)
    sqls = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        signal.alarm(LIMIT_S)
        try:
            problem, n = compare(spark, con, fn, sqls.get(name), sf)
        except Exception as e:  # report and go on with the next query
            problem, n = f"{type(e).__name__}: {str(e)[:1500]}", -1
        finally:
            signal.alarm(0)
        bad += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name:32s} {n:7d} rows {time.time() - start:6.2f}s {'' if name in sqls else '(rows only)'} {problem or ''}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
