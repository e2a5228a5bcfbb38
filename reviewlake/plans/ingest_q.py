"""Ingest and lake queries: event building, bronze, silver, rejects, round trips.

Queries that write (bronze, silver, CSV) use a fresh folder under the
session's checkpoint directory and return the table read back from it.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.operators import clean as C
from reviewlake.plans.registry import WS_SQL, register, with_views
from reviewlake.schemas import PANDAS_NULL_TOKENS, REVIEW_SCHEMA
from reviewlake.session import scratch_dir
from reviewlake.sinks.stream import event_records, publish_events
from reviewlake.sinks.tables import read_silver, write_silver
from reviewlake.sources.csv import scan_reviews_csv
from reviewlake.sources.tables import activity, reviews, scan_columns, table
from reviewlake.streaming.pipeline import silver_stream, stream_source, stream_to_bronze, write_dedup

_WS = WS_SQL
_EVENT_COLS = ["event_id", "event_type", "app_id", "app_name", "review_text",
               "review_score", "review_votes", "sentiment"]
_BUILT_SQL = f"""
SELECT event_id, 'review' AS event_type, app_id,
       coalesce(trim(app_name, {_WS}), '') AS app_name,
       coalesce(trim(review_text, {_WS}), '') AS review_text,
       review_score, coalesce(review_votes, 0) AS review_votes,
       CASE WHEN review_score = 1 THEN 'positive' ELSE 'negative' END AS sentiment
FROM reviews"""
_BRONZE_SQL = """
SELECT CAST(user_id AS VARCHAR) AS kafka_key, props AS raw_json, 'events' AS topic,
       0 AS partition, event_id AS "offset", ts AS kafka_timestamp
FROM events"""


def _raw_reviews(spark, sf):
    """The review view in the raw CSV's shape (all strings) plus its id."""
    r = reviews(spark, sf)
    return r.select("event_id", *[F.col(c).cast("string").alias(c) for c in
                                  ("app_id", "app_name", "review_text", "review_score",
                                   "review_votes")])


def _built(spark, sf):
    return C.build_event(_raw_reviews(spark, sf), event_type="review")


def _event_stream_records(df):
    """The events table read as a topic: key = user, value = props JSON."""
    return df.select(
        F.col("user_id").cast("string").alias("key"), F.col("props").alias("value"),
        F.lit("events").alias("topic"), F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"))


@register("build_event", with_views(
    _BUILT_SQL.replace("END AS sentiment", "END AS sentiment, CAST(NULL AS VARCHAR) AS reject_reason"),
    "reviews"))
def q_build_event(spark, sf):
    """Raw rows -> events (wall-clock ``timestamp`` left out of the comparison)."""
    return _built(spark, sf).drop("timestamp")


@register("bronze_project", _BRONZE_SQL)
def q_bronze_project(spark, sf):
    return C.bronze_project(_event_stream_records(table(spark, sf, "events"))).drop("ingest_time")


@register("stream_to_bronze", _BRONZE_SQL)
def q_stream_to_bronze(spark, sf):
    """File stream over the events table -> bronze, run twice (second run adds nothing)."""
    out = scratch_dir(spark, "bronze")
    schema = table(spark, sf, "events").schema
    for _ in range(2):
        src = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
               .option("maxFilesPerTrigger", "1").parquet(sf))
        stream_to_bronze(_event_stream_records(src), f"{out}/bronze", f"{out}/_ckpt")
    return spark.read.parquet(f"{out}/bronze").drop("ingest_time")


@register("bronze_to_silver", with_views(_BUILT_SQL, "reviews"))
def q_bronze_to_silver(spark, sf):
    """reviews -> events -> JSON records on a topic folder -> stream -> bronze -> silver."""
    out = scratch_dir(spark, "lake")
    built = _built(spark, sf).where(F.col("reject_reason").isNull()).drop("reject_reason")
    publish_events(built, f"{out}/topic", fmt="json", topic="reviews")
    stream_to_bronze(stream_source(spark, f"{out}/topic", fmt="json", max_files_per_trigger=4),
                     f"{out}/bronze", f"{out}/_ckpt")
    bronze = spark.read.parquet(f"{out}/bronze")
    return C.bronze_to_silver(bronze).select(*_EVENT_COLS)


def ingest_in_batches(spark, sf) -> str:
    """reviews published in three batches, each streamed to bronze and silver as it
    arrives by bytes; the folder of the batches' length histograms."""
    out = scratch_dir(spark, "batches")
    built = _built(spark, sf).where(F.col("reject_reason").isNull()).drop("reject_reason")
    for part in range(3):
        publish_events(built.where(F.pmod("event_id", F.lit(3)) == part), f"{out}/topic", batch_id=str(part))
        src = stream_source(spark, f"{out}/topic", max_bytes_per_trigger=1 << 20)
        stream_to_bronze(src, f"{out}/bronze", f"{out}/_b")
        bronze = spark.readStream.schema(spark.read.parquet(f"{out}/bronze").schema).parquet(f"{out}/bronze")
        silver_stream(bronze, f"{out}/silver", f"{out}/rejects", f"{out}/_s", counts_path=f"{out}/lengths")
    return f"{out}/lengths"


@register("clean_events", with_views(_BUILT_SQL, "reviews"))
def q_clean_events(spark, sf):
    """Batch form: records -> bronze projection -> parse, normalise, validate."""
    built = _built(spark, sf).where(F.col("reject_reason").isNull()).drop("reject_reason")
    bronze = C.bronze_project(event_records(built))
    return C.bronze_to_silver(bronze).select(*_EVENT_COLS)


@register("write_silver", with_views(_BUILT_SQL, "reviews"))
def q_write_silver(spark, sf):
    """Silver + rejects written in one job as a snapshot, read back (valid rows)."""
    out = scratch_dir(spark, "silver")
    built = _built(spark, sf).where(F.col("reject_reason").isNull()).drop("reject_reason")
    tagged = C.tag_events(C.bronze_project(event_records(built)))
    write_silver(tagged, f"{out}/silver")
    return read_silver(spark, f"{out}/silver").select(*_EVENT_COLS)


@register("scan_columns", with_views("SELECT event_id, app_id FROM reviews", "reviews"))
def q_scan_columns(spark, sf):
    out = scratch_dir(spark, "silver")
    built = _built(spark, sf).where(F.col("reject_reason").isNull()).drop("reject_reason")
    write_silver(C.tag_events(C.bronze_project(event_records(built))), f"{out}/silver")
    return scan_columns(spark, f"{out}/silver", ["event_id", "app_id", "status"]).where(
        F.col("status") == "valid").drop("status")


@register("reject_events", """
SELECT props AS raw_json, 'missing_event_id' AS reject_reason, false AS malformed
FROM events""")
def q_reject_events(spark, sf):
    """A topic of foreign messages (event props) is rejected whole, with reasons."""
    bronze = C.bronze_project(_event_stream_records(table(spark, sf, "events")))
    return C.reject_events(C.tag_events(bronze)).drop("event_id")


@register("parse_json", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def q_parse_json(spark, sf):
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    return C.parse_json(table(spark, sf, "events"), "props", keep=("event_id",),
                        schema=schema).drop(C.CORRUPT_COL)


@register("parse_event_time", "SELECT event_id, ts AS event_time FROM events")
def q_parse_event_time(spark, sf):
    ev = table(spark, sf, "events").select(
        "event_id",
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
        .alias("timestamp"))
    return C.parse_event_time(ev).drop("timestamp")


@register("normalise_text", "SELECT event_id, trim(lower(event_type)) AS event_type FROM events")
def q_normalise_text(spark, sf):
    return C.normalise_text(table(spark, sf, "events").select("event_id", "event_type"),
                            ("event_type",))


@register("dedup_events", with_views("""
SELECT app_id, event_id, event_time FROM (
  SELECT *, row_number() OVER (PARTITION BY app_id ORDER BY event_time, event_id) AS rn
  FROM activity) t WHERE rn = 1""", "activity"))
def q_dedup_events(spark, sf):
    """Earliest event per user (key with many copies, partially aggregated)."""
    a = activity(spark, sf).select("app_id", "event_id", "event_time")
    return C.dedup_events(a, key="app_id", order=("event_time",))


@register("dedup_stream", "SELECT event_id, ts AS event_time, user_id FROM events")
def q_dedup_stream(spark, sf):
    """Events arriving in time order, every file twice, in micro-batches bounded by bytes and
    with a restart in between: the second run's state drops what the first has written."""
    out = scratch_dir(spark, "dedup")
    ev = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("event_time"), "user_id")
    t = F.unix_micros("event_time")
    lo, hi = ev.agg(F.min(t), F.max(t)).first()
    slot = F.floor((t - F.lit(lo or 0)) * 6 / F.lit((hi or 0) - (lo or 0) + 1))

    def arrive(part: int) -> None:
        ev.where(slot == part).write.mode("append").parquet(f"{out}/files")

    def drain() -> None:
        src = stream_source(spark, f"{out}/files", fmt="parquet", schema=ev.schema, max_bytes_per_trigger=1 << 20)
        write_dedup(src, f"{out}/deduped", f"{out}/_ckpt", lateness="1 hour")

    for parts in ((0, 0, 1, 1, 2, 2), (2, 3, 3, 4, 4, 5, 5)):
        for part in parts:
            arrive(part)
        drain()
    return spark.read.parquet(f"{out}/deduped")


def _null_tok(c: str) -> str:
    toks = ", ".join("'" + t.replace("'", "''") + "'" for t in PANDAS_NULL_TOKENS)
    return f"CASE WHEN {c} IN ({toks}) THEN NULL ELSE {c} END"


@register("scan_reviews_csv", with_views(f"""
SELECT {_null_tok('CAST(app_id AS VARCHAR)')} AS app_id, {_null_tok('app_name')} AS app_name,
       {_null_tok('review_text')} AS review_text,
       {_null_tok('CAST(review_score AS VARCHAR)')} AS review_score,
       {_null_tok('CAST(review_votes AS VARCHAR)')} AS review_votes
FROM reviews""", "reviews"))
def q_scan_reviews_csv(spark, sf):
    """Reviews written as RFC-4180 CSV (quoted multi-line text) and scanned back."""
    out = scratch_dir(spark, "csv")
    raw = _raw_reviews(spark, sf).drop("event_id")
    (raw.write.option("header", True).option("quote", '"').option("escape", '"')
     .csv(f"{out}/reviews_csv"))
    return scan_reviews_csv(spark, f"{out}/reviews_csv")


@register("publish_events", with_views(f"""
SELECT CAST(app_id AS VARCHAR) AS key, 'reviews' AS topic, event_id AS "offset", app_id, review_score, sentiment,
       length(coalesce(trim(review_text, {_WS}), '')) AS text_chars
FROM reviews""", "reviews"))
def q_publish_events(spark, sf):
    """Review events published as keyed JSON records, the same batch twice; what the topic then holds."""
    out = scratch_dir(spark, "topic")
    built = _built(spark, sf).where(F.col("reject_reason").isNull()).drop("reject_reason")
    for _ in range(2):
        publish_events(built, f"{out}/topic", fmt="json", batch_id="2024-01-01")
    records = spark.read.schema(event_records(built).schema).json(f"{out}/topic")
    value = F.from_json("value", REVIEW_SCHEMA)
    return records.select("key", "topic", "offset", value["app_id"].alias("app_id"), value["review_score"].alias("review_score"),
                          value["sentiment"].alias("sentiment"), F.length(value["review_text"]).alias("text_chars"))
