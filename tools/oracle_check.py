"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

    python tools/oracle_check.py [sf_dir] [query ...]

Compares row count, column names and an order-insensitive multiset of
normalized rows. Prints one line per query and exits non-zero on mismatch.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, (dt.date, bool, int, str)):
        return str(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(str(norm(x)) for x in v) + "]"
    return str(v)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(norm(r[i]) for i in order) for r in rows)


def duck(sf_dir: str, sql: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def compare(spark, name: str, sf_dir: str) -> tuple[bool, str, int]:
    """(match, detail, spark rows) of one registered query against its oracle."""
    from eventlake.plans.registry import ORACLES, QUERIES

    df = QUERIES[name](spark, sf_dir)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    d_cols, d_rows = duck(sf_dir, ORACLES[name])
    sc, sm = canon(s_cols, s_rows)
    dc, dm = canon(d_cols, d_rows)
    if sc != dc:
        return False, f"columns spark={sc} duck={dc}", len(s_rows)
    if sm != dm:
        return False, f"only spark={list((sm - dm).items())[:2]} only duck={list((dm - sm).items())[:2]}", len(s_rows)
    return True, "", len(s_rows)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    from eventlake import session
    from eventlake.plans.registry import ORACLES, QUERIES

    spark = session.local_session(8)
    bad = 0
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{name:24s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        t1 = time.time()
        if name not in ORACLES:
            print(f"{name:24s} rows={len(s_rows):7d} (no oracle) spark={t1-t0:.1f}s")
            continue
        try:
            d_cols, d_rows = duck(sf_dir, ORACLES[name])
        except Exception as e:  # noqa: BLE001
            print(f"{name:24s} DUCKDB ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        sc, sm = canon(s_cols, s_rows)
        dc, dm = canon(d_cols, d_rows)
        ok = sc == dc and sm == dm
        status = "OK " if ok else "MISMATCH"
        print(f"{name:24s} {status} spark_rows={len(s_rows):7d} duck_rows={len(d_rows):7d} spark={t1-t0:.1f}s")
        if not ok:
            bad += 1
            if sc != dc:
                print("   columns spark:", sc, "\n   columns duck: ", dc)
            else:
                only_s = list((sm - dm).items())[:3]
                only_d = list((dm - sm).items())[:3]
                print("   only spark:", only_s, "\n   only duck: ", only_d)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
