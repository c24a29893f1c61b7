"""Runs registered queries on Spark and their comparison SQL on DuckDB and compares rows, columns and values."""

from __future__ import annotations

import datetime
import math
import sys
import time

import duckdb

from pitwall.catalog.registry import load_all, runnable

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (0.0 if v == 0 else round(v, 6))
    if isinstance(v, (datetime.datetime, datetime.date)):
        return str(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, q) -> str | None:
    """None when equal, else the first difference."""
    df = runnable(q)(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if q.sql is None:
        return None if df.columns else "no columns"
    cur = con.execute(q.sql)
    names = [c[0] for c in cur.description]
    huge = [n for n, t in zip(names, cur.description) if "HUGEINT" in str(t[1])]
    if huge:
        return f"huge integers in {huge}"
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns differ: spark only {sorted(set(df.columns) - set(names))}, sql only {sorted(set(names) - set(df.columns))}"
    a, b = _rows(df.columns, got), _rows(names, want)
    if len(a) != len(b):
        return f"{len(a)} rows, expected {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            diff = [(n, u, v) for n, u, v in zip(sorted(names), x, y) if u != v or type(u) is not type(v)]
            return f"differs in {diff[:4]}"
        bad = [(n, type(u), type(v)) for n, u, v in zip(sorted(names), x, y) if type(u) is not type(v)]
        if bad:
            return f"types differ {bad[:4]}"
    return None


def main(argv: list[str]) -> int:
    from pitwall.session import local_session

    sf_dir = "/root/testdata/sf0.01"
    wanted = argv
    spark, con, failed = local_session(), connect(sf_dir), 0
    for name, q in load_all().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            message = compare(spark, con, sf_dir, q)
        except Exception as e:  # noqa: BLE001
            message = f"{type(e).__name__}: {str(e)[:700]}"
        failed += message is not None
        print(f"{'FAIL' if message else 'ok  '} {name} {time.time() - start:.1f}s {message or ''}{'' if q.sql else ' (no sql)'}", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) > 0)
