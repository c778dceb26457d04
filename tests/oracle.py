"""Comparison of a query's rows with those of its SQL in DuckDB."""

import math
from pathlib import Path

import duckdb
import pandas as pd


def connect(sf_dir):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for p in Path(sf_dir).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return c


def value(v):
    if v is None or v is pd.NA or isinstance(v, float) and math.isnan(v):
        return "~"
    if isinstance(v, float):  # whole numbers beside nulls arrive as floats
        return str(int(v)) if v == int(v) else f"{v:.6g}"
    return str(v)


def same(spark_frame, sql, sf_dir):
    got = spark_frame.toPandas()
    want = connect(sf_dir).execute(sql).fetch_df()
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda x: sorted(tuple(value(v) for v in r) for r in x[sorted(x.columns)].astype(object).itertuples(index=False))
    assert rows(got) == rows(want)
