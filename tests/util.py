"""Result comparison shared by the tests (mirrors tools/check_oracle.py)."""

import math

import duckdb
import pandas as pd

from reviewlake.sources.tables import TABLES


def norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return norm(v.item())
        except Exception:  # noqa: BLE001
            pass
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None).isoformat()
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat() if hasattr(v, "tzinfo") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(norm(x) for x in r) for r in
                         pdf[cols].itertuples(index=False, name=None)), key=repr)


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con
