"""Compares a query with its SQL in DuckDB."""

import datetime
import decimal
import math
import os

import duckdb

from civicspark.plans.bindings import TABLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(v):
    if hasattr(v, "asDict"):
        v = v.asDict(True)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v if v is None or isinstance(v, (int, bool, str)) else str(v)


def compare(spark, query, sql, sf_dir=SF_DIR):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = query(spark, sf_dir)
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    assert sorted(df.columns) == sorted(names)
    theirs = sorted(repr([plain(dict(zip(names, r, strict=True))[c]) for c in sorted(names)]) for r in got.fetchall())
    ours = sorted(repr([plain(r[c]) for c in sorted(names)]) for r in df.collect())
    assert ours == theirs
