"""Rows of a query and of its SQL, in a form that can be compared."""

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SMALL = "/root/testdata/sf0.001"


def connect(sf_dir: str = SMALL):
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


def cell(v):
    if v is None or v is pd.NA or (isinstance(v, float) and v != v):
        return "~"
    if isinstance(v, bool) or type(v).__name__ in ("bool", "bool_"):
        return str(bool(v))
    try:
        return f"{float(v):.9g}" if not isinstance(v, str) else v
    except (TypeError, ValueError):
        return str(v)


def rows(frame) -> list:
    return sorted(tuple(map(cell, r)) for r in frame[sorted(frame.columns)].astype(object).itertuples(index=False))
