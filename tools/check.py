"""Runs catalogue queries beside their comparison SQL and reports differences.

    python tools/check.py [--sf DIR] [name ...]
"""

import argparse
import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from dustline.registry import load  # noqa: E402
from dustline.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, (bool, str, bytes)):
        return v
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def kind(v):
    return type(v).__name__


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--show", action="store_true")
    ap.add_argument("--plan", action="store_true")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    os.environ["TZ"] = "UTC"
    time.tzset()
    spark = build_session("check", os.environ.get("CHECK_MASTER", "local[8]"), **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
                                                  "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.host": "127.0.0.1"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{a.sf}/{t}.parquet'")
    bad = []
    cat = load()
    names = [n for n in cat if not a.names or any(n == p or (p.endswith("*") and n.startswith(p[:-1])) for p in a.names)]
    for name in names:
        q = cat[name]
        t0 = time.time()
        try:
            df = q.build(spark, a.sf)
            if a.plan:
                df.explain("formatted")
            rows = [r.asDict() for r in df.collect()]
            cols = sorted(df.columns)
            t1 = time.time()
            msg = f"{name}: {len(rows)} rows {t1 - t0:.1f}s"
            if a.show:
                for x in rows[:5]:
                    print("   ", x)
            if q.sql is None:
                print("rows ", msg)
                continue
            rel = con.execute(q.sql)
            ocols = [d[0] for d in rel.description]
            orows = [dict(zip(ocols, x)) for x in rel.fetchall()]
            if sorted(ocols) != cols:
                print("COLS ", msg, sorted(set(ocols) ^ set(cols)))
                bad.append(name)
                continue
            key = lambda x: repr(x)
            left = sorted((tuple(norm(x[c]) for c in cols) for x in rows), key=key)
            right = sorted((tuple(norm(x[c]) for c in cols) for x in orows), key=key)
            if left != right:
                bad.append(name)
                diff = [(p, q_) for p, q_ in zip(left, right) if p != q_]
                print("DIFF ", msg, f"oracle {len(right)} rows, {len(diff)} differ; cols {cols}")
                for p, q_ in diff[:3]:
                    print("    spark ", p)
                    print("    oracle", q_)
                continue
            types = {c: (kind(rows[0][c]), kind(orows[0][c])) for c in cols} if rows else {}
            odd = {c: t for c, t in types.items() if t[0] != t[1] and "NoneType" not in t}
            print("ok   ", msg, f"oracle {time.time() - t1:.1f}s", odd or "", "EMPTY" if not rows else "", flush=True)
        except Exception as e:  # noqa: BLE001
            bad.append(name)
            print("FAIL ", name, str(e)[:1500], flush=True)
    print(f"{len(names) - len(bad)}/{len(names)} good", "bad:" if bad else "", *bad)
    spark.stop()


if __name__ == "__main__":
    main()
