"""Run a registered Spark query and its DuckDB oracle side by side.

Mirrors the driver's check: same column names, same row count, and the
same multiset of rows after normalising values (floats to 6 places).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb
import pandas as pd

BASE_TABLES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, decimal.Decimal):
        return _norm(float(v))
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        if v.hour == v.minute == v.second == v.microsecond == 0:
            return v.date().isoformat()
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if v is pd.NaT:
        return None
    return v


def rows_of(df: pd.DataFrame):
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return cols, sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) or isinstance(b, float):
        try:
            return math.isclose(float(a), float(b), rel_tol=1e-9, abs_tol=2e-6)
        except (TypeError, ValueError):
            return False
    return a == b


def compare(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame) -> tuple[bool, str]:
    sc, sr = rows_of(spark_pdf)
    oc, orr = rows_of(oracle_pdf)
    if sc != oc:
        return False, f"columns differ: spark={sc} oracle={oc}"
    if len(sr) != len(orr):
        return False, f"row count differs: spark={len(sr)} oracle={len(orr)}"
    exact = sr == orr
    for a, b in zip(sr, orr):
        if not all(_close(x, y) for x, y in zip(a, b)):
            return False, f"row differs:\n spark ={a}\n oracle={b}"
    return True, "exact" if exact else "close"
