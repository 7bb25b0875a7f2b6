"""Run registered queries on Spark and their oracle SQL on DuckDB, compare.

Comparison mirrors the driver: row count, column names, and an
order-insensitive multiset of rows with columns sorted by name. Values are
compared strictly (a DECIMAL must keep its scale, a float must be bit-equal).

CLI:  python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import json
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from tillroll.sources.fixtures import TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return ("n",)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, float):
        return ("f", 0.0 if v == 0 else v)
    if isinstance(v, decimal.Decimal):
        return ("d", str(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return ("t", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("l", tuple(norm(x) for x in v))
    if isinstance(v, dict):
        return ("m", tuple(sorted((str(k), norm(x)) for k, x in v.items())))
    return ("s", str(v))


def rows_key(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, sf_dir: str, name: str, fn, sql: str | None, con) -> dict:
    res = {"query": name}
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    res["spark_sec"] = round(time.time() - t0, 2)
    res["rows"] = len(s_rows)
    s_names = sdf.columns
    if sql is None:
        res["status"] = "rows-only"
        return res
    t0 = time.time()
    cur = con.execute(sql)
    d_names = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    res["duck_sec"] = round(time.time() - t0, 2)
    res["duck_rows"] = len(d_rows)
    if sorted(s_names) != sorted(d_names):
        res["status"] = "schema-mismatch"
        res["detail"] = {"spark": s_names, "duck": d_names}
        return res
    if len(s_rows) != len(d_rows):
        res["status"] = "rowcount-mismatch"
        return res
    a, b = rows_key(s_names, s_rows), rows_key(d_names, d_rows)
    if a == b:
        res["status"] = "match"
    else:
        res["status"] = "value-mismatch"
        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
        cols = sorted(s_names)
        res["detail"] = [{c: (p, q) for c, p, q in zip(cols, x, y) if p != q} for x, y in diff]
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = set(argv[2:])
    from tillroll.session import build_session
    import __spark_entry__ as E

    spark = build_session(cores=8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = []
    for name, fn in qs.items():
        if wanted and name not in wanted:
            continue
        try:
            r = compare(spark, sf_dir, name, fn, sqls.get(name), con)
        except Exception as exc:  # report and continue
            r = {"query": name, "status": "error", "detail": repr(exc)[:800]}
        results.append(r)
        print(json.dumps(r, default=str), flush=True)
    bad = [r["query"] for r in results if r["status"] not in ("match", "rows-only")]
    print(json.dumps({"total": len(results), "bad": bad}))
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
