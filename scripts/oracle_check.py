"""Run every catalog query in Spark and its oracle SQL in DuckDB; compare results.

usage: python scripts/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from riskspark.plans import catalog, extra  # noqa: E402,F401
from riskspark.session import local_session  # noqa: E402
from riskspark.sources.tables import TABLES, table_path  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = table_path(sf_dir, t)
        if Path(p).exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, v)
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, bool):
        return (1, int(v))
    return (1, v)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in records:
        out.append(tuple(norm(r[i]) for i in order))
    return sorted(out, key=repr), [cols[i] for i in order]


def compare(spark, con, name, sf_dir):
    t0 = time.time()
    sdf = catalog.QUERIES[name](spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    sql = catalog.ORACLES.get(name)
    if sql is None:
        return name, "rows-only", len(s_rows), t1 - t0, ""
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    a, ac = rows_of(sdf.columns, s_rows)
    b, bc = rows_of(d_cols, d_rows)
    if ac != bc:
        return name, "COLUMNS", len(s_rows), t1 - t0, f"spark={ac} duck={bc}"
    if len(a) != len(b):
        return name, "ROWCOUNT", len(s_rows), t1 - t0, f"spark={len(a)} duck={len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return name, "VALUES", len(s_rows), t1 - t0, f"{len(bad)} rows differ, first: {bad[0]}"
    return name, "ok", len(s_rows), t1 - t0, ""


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")] or list(catalog.QUERIES)
    spark = local_session()
    con = duck(sf_dir)
    failures = 0
    for n in names:
        try:
            r = compare(spark, con, n, sf_dir)
        except Exception as e:  # noqa: BLE001
            r = (n, "ERROR", 0, 0.0, repr(e)[:400])
        print(f"{r[0]:32s} {r[1]:10s} rows={r[2]:<7d} {r[3]:6.2f}s {r[4]}", flush=True)
        failures += r[1] not in ("ok", "rows-only")
    print(f"failures: {failures}")
    return failures


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
