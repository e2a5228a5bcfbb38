"""Queries for display mapping, set stacking, extensions E1-E3 and streaming silver."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlake.operators import clean as C
from reviewlake.operators import features as X
from reviewlake.operators import profile as P
from reviewlake.operators import sampling as S
from reviewlake.operators.reports import concat_results
from reviewlake.plans.ingest_q import _BUILT_SQL, _EVENT_COLS, _built
from reviewlake.plans.registry import register, with_views
from reviewlake.schemas import SCORE_LABELS
from reviewlake.session import scratch_dir
from reviewlake.sinks.stream import publish_events
from reviewlake.sources.tables import activity, reviews, table
from reviewlake.streaming.pipeline import (
    hourly_trend_stream, read_hourly_trend, silver_stream, stream_source, stream_to_bronze, write_hourly_trend)

_TRAIN = "md5(CAST(event_id AS VARCHAR)) < 'cccccccc'"


@register("map_values", with_views("""
SELECT review_score, count(*) AS count,
       CASE review_score WHEN 1 THEN 'Positive (1)' WHEN -1 THEN 'Negative (-1)' END AS score_label
FROM reviews GROUP BY review_score""", "reviews"))
def q_map_values(spark, sf):
    d = P.score_distribution(reviews(spark, sf))
    return d.withColumn("score_label", C.map_values("review_score", SCORE_LABELS))


@register("model_frame", with_views("""
SELECT event_id, review_text, sentiment, sentiment AS label_text FROM reviews
WHERE review_text IS NOT NULL AND sentiment IN ('negative', 'positive')""", "reviews"))
def q_model_frame(spark, sf):
    return C.model_frame(reviews(spark, sf))


@register("concat_results", with_views("""
SELECT 'reviews' AS source, sentiment, count(*) AS count FROM reviews GROUP BY sentiment
UNION ALL
SELECT 'activity', sentiment, count(*) FROM activity GROUP BY sentiment""", "reviews", "activity"))
def q_concat_results(spark, sf):
    parts = [P.sentiment_distribution(reviews(spark, sf)).withColumn("source", F.lit("reviews")),
             P.sentiment_distribution(activity(spark, sf)).withColumn("source", F.lit("activity"))]
    return concat_results(parts).select("source", "sentiment", "count")


@register("numeric_features", with_views(f"""
, apps AS (SELECT app_id, count(*) AS app_review_count,
                  avg(CASE WHEN sentiment = 'positive' THEN 1.0 ELSE 0.0 END) AS app_positive_ratio
           FROM reviews WHERE {_TRAIN} GROUP BY app_id)
SELECT r.event_id, length(r.review_text) AS review_text_length,
       len(list_filter(string_split_regex(lower(r.review_text), '[ \\t\\n\\v\\f\\r]'), lambda x: x <> ''))
         AS review_text_word_count,
       r.review_votes, a.app_review_count, a.app_positive_ratio
FROM reviews r LEFT JOIN apps a ON r.app_id = a.app_id""", "reviews").replace("\n, apps AS", ", apps AS", 1))
def q_numeric_features(spark, sf):
    r = reviews(spark, sf)
    return X.numeric_features(r, S.train_part(S.hash_split(r)))


@register("class_weights", with_views("""
SELECT label_text, sum(n) OVER () / (count(*) OVER () * n) AS weight
FROM (SELECT sentiment AS label_text, count(*) AS n FROM reviews
      WHERE review_text IS NOT NULL AND sentiment IN ('negative', 'positive') GROUP BY 1) c""",
    "reviews"))
def q_class_weights(spark, sf):
    return X.class_weights(C.model_frame(reviews(spark, sf)))


@register("hourly_trend_stream", """
SELECT date_trunc('hour', ts) AS hour, count(*) AS count FROM events GROUP BY 1""")
def q_hourly_trend_stream(spark, sf):
    """Windowed count over the events stream with a 1-hour watermark, run to its end."""
    out = scratch_dir(spark, "trend")
    schema = table(spark, sf, "events").schema
    src = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
           .parquet(sf).select(F.col("ts").cast("timestamp").alias("event_time")))
    write_hourly_trend(hourly_trend_stream(src, "event_time", "1 hour"), f"{out}/trend", f"{out}/_ckpt")
    return read_hourly_trend(spark, f"{out}/trend")


@register("silver_stream", with_views(_BUILT_SQL, "reviews"))
def q_silver_stream(spark, sf):
    """reviews -> topic files -> bronze stream -> silver/rejects via foreachBatch."""
    out = scratch_dir(spark, "silverstream")
    built = _built(spark, sf).where(F.col("reject_reason").isNull()).drop("reject_reason")
    publish_events(built, f"{out}/topic", fmt="json")
    stream_to_bronze(stream_source(spark, f"{out}/topic", fmt="json"), f"{out}/bronze", f"{out}/_b")
    bronze = spark.readStream.schema(spark.read.parquet(f"{out}/bronze").schema).parquet(f"{out}/bronze")
    silver_stream(bronze, f"{out}/silver", f"{out}/rejects", f"{out}/_s")
    return spark.read.parquet(f"{out}/silver").select(*_EVENT_COLS)


@register("label_grid", """
WITH s AS (SELECT CASE WHEN l.quality = 1 THEN 'positive' ELSE 'negative' END AS label_text,
                  CASE WHEN CAST(d.n_chars AS DOUBLE) / (CAST(d.n_chars AS DOUBLE) + 1000.0) >= 0.99
                       THEN 'positive' ELSE 'negative' END AS prediction_text
           FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
SELECT g.label_text, g.prediction_text, count(s.label_text) AS count
FROM (SELECT * FROM (VALUES ('negative'), ('positive')) a(label_text),
                    (VALUES ('negative'), ('positive')) b(prediction_text)) g
LEFT JOIN s ON s.label_text = g.label_text AND s.prediction_text = g.prediction_text
GROUP BY 1, 2""")
def q_label_grid(spark, sf):
    """Confusion grid at a threshold that leaves cells empty: zeros are rows, not gaps."""
    from reviewlake.operators import evaluate as V
    n = table(spark, sf, "documents").select("doc_id", "n_chars")
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    x = F.col("n_chars").cast("double")
    s = n.join(lab, "doc_id").select(
        F.col("quality").alias("label"), (x / (x + F.lit(1000.0))).alias("score"))
    return V.confusion_matrix(V.with_prediction_text(s, "score", 0.99))


@register("scan_table", with_views(_BUILT_SQL, "reviews"))
def q_scan_table(spark, sf):
    """Silver written twice as snapshots; the reader sees only the newest version."""
    from reviewlake.sinks.stream import event_records
    from reviewlake.sinks.tables import write_silver
    from reviewlake.sources.tables import scan_table
    out = scratch_dir(spark, "snap")
    built = _built(spark, sf).where(F.col("reject_reason").isNull()).drop("reject_reason")
    tagged = C.tag_events(C.bronze_project(event_records(built)))
    # an older version with stale values: reading it (or both) would fail the oracle
    write_silver(tagged.withColumn("app_name", F.lit("stale")), f"{out}/silver")
    write_silver(tagged, f"{out}/silver")
    return scan_table(spark, f"{out}/silver").where(F.col("status") == "valid").select(*_EVENT_COLS)


@register("write_report", with_views("""
SELECT sentiment, CAST(count(*) AS VARCHAR) AS count FROM reviews GROUP BY sentiment""", "reviews"))
def q_write_report(spark, sf):
    """A report written as one CSV file and read back (values come back as strings)."""
    from reviewlake.sinks.tables import write_report
    path = f"{scratch_dir(spark, 'report')}/sentiment_distribution"
    write_report(P.sentiment_distribution(reviews(spark, sf)), path)
    return spark.read.option("header", True).csv(path)


@register("stream_source", with_views("""
SELECT CAST(app_id AS VARCHAR) AS key, 'reviews' AS topic, event_id AS "offset" FROM reviews""",
    "reviews"))
def q_stream_source(spark, sf):
    """Review events published as record files, consumed as a bounded-rate stream."""
    out = scratch_dir(spark, "source")
    built = _built(spark, sf).where(F.col("reject_reason").isNull()).drop("reject_reason")
    publish_events(built, f"{out}/topic", fmt="json", topic="reviews")
    src = stream_source(spark, f"{out}/topic", fmt="json", max_files_per_trigger=2)
    q = (src.writeStream.format("parquet").option("checkpointLocation", f"{out}/_ckpt")
         .trigger(availableNow=True).start(f"{out}/records"))
    q.awaitTermination()
    return spark.read.parquet(f"{out}/records").select("key", "topic", "offset")
