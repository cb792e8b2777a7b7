"""Compare registered queries with their SQL: columns by name, rows in any order."""

import glob
import math
import os

import duckdb
import pandas as pd


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return v + 0.0  # no negative zero
    return v


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]
    return sorted((tuple(map(_plain, r)) for r in pdf.astype(object).itertuples(index=False)), key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    want = con.execute(sql).df()
    got = spark_df.toPandas()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(a, b) for a, b in zip(rows_of(got), rows_of(want)) if a != b]
    if bad:
        a, b = bad[0]
        cells = [(c, x, y) for c, x, y in zip(sorted(got.columns), a, b) if x != y]
        return f"{len(bad)} of {len(got)} rows differ, first: {cells[:4]}"
    return None
