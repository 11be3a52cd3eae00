"""Run a registered Spark query and its DuckDB oracle; compare the results.

Comparison mirrors the driver's: row count, column names (sorted), and an
order-insensitive multiset of rows with columns sorted by name.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, Counter(tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect())


def duck_rows(con, sql):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    rows = rel.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir):
    sc, sr = spark_rows(fn(spark, sf_dir))
    dc, dr = duck_rows(con, sql)
    ok_cols = sc == dc
    ok_rows = sr == dr
    n_s, n_d = sum(sr.values()), sum(dr.values())
    detail = ""
    if not ok_cols:
        detail += f" cols spark={sc} duck={dc}"
    if not ok_rows:
        only_s = list((sr - dr).elements())[:3]
        only_d = list((dr - sr).elements())[:3]
        detail += f" rows spark={n_s} duck={n_d} only_spark={only_s} only_duck={only_d}"
    return ok_cols and ok_rows, n_s, detail


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as e
    from unilake.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2].split(",")) if len(argv) > 2 else None
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, oracle = e.queries(), e.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in oracle:
            n = fn(spark, sf_dir).count()
            print(f"{name:24s} rows-only {n}")
            continue
        try:
            ok, n, detail = compare(spark, con, name, fn, oracle[name], sf_dir)
        except Exception as ex:  # noqa: BLE001
            ok, n, detail = False, -1, f" ERROR {type(ex).__name__}: {str(ex)[:400]}"
        bad += not ok
        print(f"{name:24s} {'OK ' if ok else 'BAD'} {n}{detail}")
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
