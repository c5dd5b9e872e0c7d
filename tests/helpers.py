"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import math

import duckdb
import pandas as pd

from pulsegrid.sources.tables import TABLES


def norm(v):
    if v is pd.NA or v is pd.NaT or v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows(pdf):
    cols = sorted(pdf.columns)
    out = [tuple(norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con
