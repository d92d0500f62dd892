"""Spark rows against DuckDB rows of the same tables."""

import glob
import math
import os
from collections import Counter

DATA = "/root/testdata/sf0.001"


def views(directory):
    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{directory}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) if abs(v) < 1e6 else float(f"{v:.10g}")
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def same(spark, query, sql, directory=DATA):
    df = query(spark, directory)
    cols = sorted(df.columns)
    con = views(directory)
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    assert cols == sorted(names)
    order = sorted(range(len(names)), key=names.__getitem__)
    left = Counter(tuple(map(plain, r)) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    right = Counter(tuple(plain(r[i]) for i in order) for r in got.fetchall())
    assert left == right
