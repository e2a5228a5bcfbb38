"""Named queries over the test tables: Spark plan + DuckDB oracle per operator."""

from reviewlake.plans.registry import QUERIES, ORACLE  # noqa: F401
from reviewlake.plans import (  # noqa: F401  (registers)
    profile_q, sampling_q, evaluate_q, features_q, ingest_q, models_q, extra_q,
)


def oracle_sql() -> dict[str, str]:
    """Oracle SQL per query, with the same 6-digit rounding of double columns
    that the Spark queries apply (see ``round_cols.py``)."""
    from reviewlake.plans.round_cols import ROUND_COLS
    out = {}
    for name, sql in ORACLE.items():
        cols = ROUND_COLS.get(name)
        if cols:
            rep = ", ".join(f'round(CAST("{c}" AS DOUBLE), 6) AS "{c}"' for c in cols)
            sql = f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS oracle_q"
        out[name] = sql
    return out
