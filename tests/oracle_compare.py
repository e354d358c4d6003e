"""Spark query vs DuckDB SQL twin: row count, column names, values.

Usable from pytest (``tests/test_oracle.py``) and as a script:
``python tests/oracle_compare.py [sf_dir] [name ...]``. Environment switches
for the script: ``ORACLE_SESSION_TZ`` (session time zone),
``ORACLE_SHUFFLE_PARTITIONS`` (partition count) - results must not depend on
either.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

# Spark simple type name -> DuckDB type name, for the schema check.
TYPE_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
              "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in records]
    rows.sort(key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
    return [columns[i] for i in order], rows


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as E
    q = E.queries()[name]
    sql = E.oracle_sql().get(name)
    t0 = time.time()
    df = q(spark, sf_dir)
    s_cols = df.columns
    s_types = {f.name: TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in df.schema.fields}
    s_recs = [tuple(r) for r in df.collect()]
    t1 = time.time()
    out = {"name": name, "spark_rows": len(s_recs), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con = con or duck(sf_dir)
    rel = con.sql(sql)
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_recs = cur.fetchall()
    out["duck_rows"] = len(d_recs)
    sc, sr = _rows(s_cols, s_recs)
    dc, dr = _rows(d_cols, d_recs)
    if sc != dc:
        out["status"] = f"columns differ: spark={sc} duck={dc}"
    elif s_types != d_types:
        out["status"] = f"types differ: spark={s_types} duck={d_types}"
    elif len(sr) != len(dr):
        out["status"] = "row count differs"
    elif sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        out["status"] = f"values differ, e.g. {diff}"
    else:
        out["status"] = "ok"
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as E
    from visitflow.config import local_session
    spark = local_session()
    if os.environ.get("ORACLE_SESSION_TZ"):  # the queries must not depend on the session zone
        spark.conf.set("spark.sql.session.timeZone", os.environ["ORACLE_SESSION_TZ"])
    if os.environ.get("ORACLE_SHUFFLE_PARTITIONS"):  # nor on partitioning
        spark.conf.set("spark.sql.shuffle.partitions", os.environ["ORACLE_SHUFFLE_PARTITIONS"])
    if os.environ.get("ORACLE_AQE"):
        spark.conf.set("spark.sql.adaptive.enabled", os.environ["ORACLE_AQE"])
    names = argv[2:] or sorted(E.queries())
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as exc:  # report and continue with the next query
            r = {"name": n, "status": f"error: {type(exc).__name__}: {str(exc)[:300]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} passed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
