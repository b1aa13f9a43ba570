"""Spark-vs-DuckDB comparison of the registered queries (the driver's correctness gate, locally).

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def canon(v):
    if v is None:
        return ("n",)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, float):
        return ("f", "nan" if math.isnan(v) else v + 0.0)
    if isinstance(v, decimal.Decimal):
        return ("d", str(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return ("t", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("l", tuple(canon(x) for x in v))
    if isinstance(v, dict):
        return ("m", tuple(sorted((k, canon(x)) for k, x in v.items())))
    if hasattr(v, "asDict"):
        return canon(v.asDict())
    return ("s", str(v))


def rows_multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(canon(r[i]) for i in order) for r in rows], [columns[i] for i in order]


def duck_connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E

    qs = E.queries()
    sqls = E.oracle_sql()
    con = duck_connect(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        res = {"oracle": name in sqls}
        try:
            df = qs[name](spark, sf_dir)
            srows = df.collect()
            scols = df.columns
            res["rows"] = len(srows)
            res["spark_sec"] = round(time.time() - t0, 2)
            if name in sqls:
                cur = con.execute(sqls[name])
                ocols = [c[0] for c in cur.description]
                orows = cur.fetchall()
                s_ms, s_names = rows_multiset(scols, srows)
                o_ms, o_names = rows_multiset(ocols, orows)
                res["schema"] = s_names == o_names
                res["count"] = len(srows) == len(orows)
                res["values"] = Counter(s_ms) == Counter(o_ms)
                if not res["values"] and verbose:
                    res["detail"] = _diff(s_names, o_names, s_ms, o_ms)
        except Exception as e:  # noqa: BLE001
            res["error"] = f"{type(e).__name__}: {str(e)[:600]}"
        res["sec"] = round(time.time() - t0, 2)
        results[name] = res
        ok = res.get("values", res.get("rows") is not None and "error" not in res)
        if verbose:
            print(f"{'OK ' if ok else 'BAD'} {name:28s} {res}", flush=True)
    return results


def _diff(sn, on, s_ms, o_ms):
    out = []
    if sn != on:
        out.append(f"cols spark={sn} oracle={on}")
    cs, co = Counter(s_ms), Counter(o_ms)
    only_s = list((cs - co).elements())[:3]
    only_o = list((co - cs).elements())[:3]
    out.append(f"only_spark={only_s}")
    out.append(f"only_oracle={only_o}")
    return " | ".join(out)


def make_spark():
    from leasekit.session import get_session

    return get_session("local[8]", 8)


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = make_spark()
    r = compare(spark, sf, names)
    bad = [k for k, v in r.items() if not v.get("values", "error" not in v)]
    print(f"\n{len(r) - len(bad)}/{len(r)} ok; bad: {bad}")
