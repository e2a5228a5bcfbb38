"""Query registry: name -> (spark, sf_dir) -> DataFrame, plus oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reviewlake.functions.exprs import round_doubles
from reviewlake.schemas import PY_WHITESPACE

QueryFn = Callable[[SparkSession, str], DataFrame]

# DuckDB spelling of Python's str.isspace() set, for trim(x, chars)
WS_SQL = " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE)

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

# The two views over the test tables, written once so Spark SQL and DuckDB
# run the identical text (see the README's "test data" section).
REVIEWS_SQL = """
SELECT d.doc_id AS event_id,
       'review' AS event_type,
       CAST(substr(d.source, 4) AS INT) AS app_id,
       d.source AS app_name,
       d.text AS review_text,
       CASE WHEN l.quality = 1 THEN 1 ELSE -1 END AS review_score,
       l.toxic AS review_votes,
       CASE WHEN l.quality = 1 THEN 'positive' ELSE 'negative' END AS sentiment
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""

# All documents, for queries that need no label.
TEXTS_SQL = """
SELECT doc_id AS event_id, CAST(substr(source, 4) AS INT) AS app_id, source AS app_name, text AS review_text
FROM documents
"""

ACTIVITY_SQL = """
SELECT event_id, ts AS event_time, user_id AS app_id, event_type AS sentiment,
       value AS review_votes, props AS raw_json
FROM events
"""

# Synthetic score for evaluation queries that need no model.
SCORED_SQL = """
SELECT d.doc_id AS event_id, l.quality AS label,
       round(CAST(d.n_chars AS DOUBLE) / (CAST(d.n_chars AS DOUBLE) + 1000.0), 6) AS score
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""


def with_views(sql: str, *views: str) -> str:
    """Prefix ``sql`` with CTEs for the named views (reviews/texts/activity/scored)."""
    defs = {"reviews": REVIEWS_SQL, "texts": TEXTS_SQL, "activity": ACTIVITY_SQL, "scored": SCORED_SQL}
    ctes = ",\n".join(f"{v} AS ({defs[v]})" for v in views)
    return f"WITH {ctes}\n{sql}" if views else sql


def register(name: str, sql: str | None = None, round_digits: int | None = 6):
    """Register a query; its result doubles are rounded for cross-engine hashing."""
    def deco(fn: QueryFn) -> QueryFn:
        def wrapped(spark: SparkSession, sf_dir: str, _fn=fn) -> DataFrame:
            # the library's contract: UTC sessions (hour buckets, ISO offsets)
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            df = _fn(spark, sf_dir)
            return df if round_digits is None else round_doubles(df, round_digits)
        wrapped.__name__ = fn.__name__
        wrapped.__doc__ = fn.__doc__
        QUERIES[name] = wrapped
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco
