"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name-substring ...]
Comparison: same column names, same row count, same multiset of rows after
rounding floats to 6 places (order-insensitive, like the driver).
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def _kind_spark(t):
    n = t.simpleString()
    if n in ("tinyint", "smallint", "int", "bigint"):
        return "int"
    if n in ("float", "double") or n.startswith("decimal"):
        return "float" if not n.startswith("decimal") else "decimal"
    if n == "string":
        return "str"
    if n == "boolean":
        return "bool"
    return n


def _kind_duck(t):
    t = t.upper()
    if t in ("TINYINT", "SMALLINT", "INTEGER", "BIGINT", "HUGEINT", "UTINYINT", "USMALLINT", "UINTEGER", "UBIGINT"):
        return "int"
    if t in ("FLOAT", "DOUBLE"):
        return "float"
    if t.startswith("DECIMAL"):
        return "decimal"
    if t == "VARCHAR":
        return "str"
    if t == "BOOLEAN":
        return "bool"
    return t.lower()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for tname in TABLES:
        p = f"{sf_dir}/{tname}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {tname} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = sdf.collect()
    scols = sdf.columns
    t1 = time.time()
    if sql is None:
        return dict(name=name, ok=None, rows=len(srows), spark_s=round(t1 - t0, 2))
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    order = sorted(range(len(scols)), key=lambda i: scols[i])
    dorder = sorted(range(len(dcols)), key=lambda i: dcols[i])
    s = Counter(tuple(_norm(r[i]) for i in order) for r in srows)
    d = Counter(tuple(_norm(r[i]) for i in dorder) for r in drows)
    ok = sorted(scols) == sorted(dcols) and len(srows) == len(drows) and s == d
    out = dict(name=name, ok=ok, rows=len(srows), oracle_rows=len(drows),
               spark_s=round(t1 - t0, 2))
    stypes = {f.name: _kind_spark(f.dataType) for f in sdf.schema.fields}
    dtypes = {d[0]: _kind_duck(str(d[1])) for d in res.description}
    warn = {c: (stypes.get(c), dtypes.get(c)) for c in stypes if stypes.get(c) != dtypes.get(c)}
    if warn:
        out["type_warn"] = warn
    if not ok:
        out["cols"] = (scols, dcols)
        out["only_spark"] = list((s - d).items())[:3]
        out["only_oracle"] = list((d - s).items())[:3]
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in argv[1:] if not a.startswith("/")]
    from pharmaflow.session import get_spark
    from pharmaflow.plans import REGISTRY
    spark = get_spark("local[8]", shuffle_partitions=8, extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("ORACLE_TZ"):  # results must not depend on the session time zone
        spark.conf.set("spark.sql.session.timeZone", os.environ["ORACLE_TZ"])
    con = duck(sf_dir)
    bad = 0
    for name, (fn, sql) in REGISTRY.items():
        if pats and not any(p in name for p in pats):
            continue
        try:
            r = compare(spark, con, name, fn, sql, sf_dir)
        except Exception as e:  # report and continue
            r = dict(name=name, ok=False, error=f"{type(e).__name__}: {str(e)[:400]}")
        if r.get("ok") is False:
            bad += 1
        print(r, flush=True)
    print("FAILED:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
