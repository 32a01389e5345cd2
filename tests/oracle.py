"""Compare registered queries with their checking SQL: ``python tests/oracle.py [sf] [name ...]``."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from asterion.queries.adapters import TABLES  # noqa: E402


def duck(dir: str):
    import duckdb
    con = duckdb.connect()
    for n in TABLES:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{dir}/{n}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9) + 0.0
    if isinstance(v, dt.timedelta):
        return v.total_seconds()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    out = [tuple(plain(r[k]) for k in order) for r in rows]
    out.sort(key=lambda r: tuple((x is None, str(type(x)) if isinstance(x, bool) else "", str(x)) for x in r))
    return [columns[k] for k in order], out


def compare(spark, con, f, sql, dir):
    """None when equal, else what differs."""
    df = f(spark, dir)
    cols, rows = table(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None, len(rows)
    cur = con.execute(sql)
    ocols, orows = table([c[0] for c in cur.description], cur.fetchall())
    if cols != ocols:
        return f"columns {cols} != {ocols}", len(rows)
    if len(rows) != len(orows):
        return f"rows {len(rows)} != {len(orows)}", len(rows)
    for a, b in zip(rows, orows):
        if a != b:
            diff = [(c, x, y) for c, x, y in zip(cols, a, b) if x != y]
            return f"{diff}  in {a}", len(rows)
    return None, len(rows)


def main():
    from asterion.queries import ORACLES, QUERIES
    from asterion.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("check", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                      "spark.driver.memory": "8g", "spark.master": "local[8]"})
    spark.sparkContext.setLogLevel("ERROR")
    dir = f"/root/testdata/sf{sf}"
    con = duck(dir)
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            problem, k = compare(spark, con, QUERIES[n], ORACLES.get(n), dir)
        except Exception as ex:  # noqa: BLE001
            problem, k = f"{type(ex).__name__}: {str(ex)[:700]}", -1
        bad += problem is not None
        mark = "FAIL" if problem else ("ok" if n in ORACLES else "rows")
        print(f"{mark:4} {n:34} {k:7} {time.time() - t0:6.2f}s {problem or ''}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
