"""Run registered queries against their SQL twins: python tools/compare.py [sf_dir] [name-prefix ...]."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(value):
    """One form per value, so that equal results compare equal across engines."""
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if hasattr(value, "as_tuple"):
        return round(float(value), 6)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    return value


def sortable(row):
    return tuple((v is None, str(type(v).__name__), str(v)) for v in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=sortable)


def compare(spark, con, name, fn, sql, folder):
    """None if equal, else a text saying what differs."""
    df = fn(spark, folder)
    sc, sr = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.sql(sql)
    dc, dr = rows_of(res.columns, res.fetchall())
    if sc != dc:
        return f"columns {sc} vs {dc}"
    if len(sr) != len(dr):
        return f"rows {len(sr)} vs {len(dr)}\n  only spark {list(set(map(str, sr)) - set(map(str, dr)))[:2]}\n  only sql {list(set(map(str, dr)) - set(map(str, sr)))[:2]}"
    bad = [(a, b) for a, b in zip(sr, dr) if a != b]
    if bad:
        return f"{len(bad)} of {len(sr)} rows differ\n  spark {bad[0][0]}\n  sql   {bad[0][1]}"
    kinds = {c: t for c, t in df.dtypes}
    duck_kinds = dict(zip(res.columns, map(str, res.types)))
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
             "timestamp_ntz": "TIMESTAMP", "date": "DATE"}
    odd = {c: (k, duck_kinds[c]) for c, k in kinds.items() if names.get(k, duck_kinds[c]) != duck_kinds[c] or k == "timestamp"}
    if odd:
        return f"types {odd}"
    return "no rows" if not sr else None


def main():
    from weftline.queries import ORACLES, QUERIES, load_all
    from weftline.session import build_session

    args = sys.argv[1:]
    folder = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    load_all()
    spark = build_session("compare", "local[8]", {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(folder), 0
    for name, fn in QUERIES.items():
        if args and not any(name.startswith(a) for a in args):
            continue
        start = time.time()
        try:
            if name in ORACLES:
                problem = compare(spark, con, name, fn, ORACLES[name], folder)
            else:
                problem = None if fn(spark, folder).count() else "no rows"
        except Exception as e:  # noqa: BLE001 - a report of all queries is wanted
            problem = f"{type(e).__name__}: {str(e)[:900]}"
        took = time.time() - start
        print(f"{'ok  ' if problem is None else 'BAD '} {name} {took:.1f}s{'' if name in ORACLES else ' (no twin)'}", flush=True)
        if problem:
            bad += 1
            print("  ", problem, flush=True)
    print(f"{bad} bad", flush=True)
    spark.stop()
    os._exit(1 if bad else 0)


if __name__ == "__main__":
    main()
