"""Profile (EDA) queries over the ``reviews`` and ``activity`` views."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlake.operators import profile as P
from reviewlake.operators.clean import model_frame
from reviewlake.plans.registry import WS_SQL, register, with_views
from reviewlake.streaming.pipeline import read_length_counts
from reviewlake.sources.tables import activity, reviews, texts

_REVIEW_COLS = ["event_id", "event_type", "app_id", "app_name", "review_text",
                "review_score", "review_votes", "sentiment"]
_REVIEW_STRINGS = {"event_type", "app_name", "review_text", "sentiment"}


@register("sentiment_distribution", with_views(
    "SELECT sentiment, count(*) AS count FROM reviews GROUP BY sentiment", "reviews"))
def q_sentiment_distribution(spark, sf):
    return P.sentiment_distribution(reviews(spark, sf))


@register("basic_summary", with_views("""
SELECT 'total_rows' AS metric, count(*) AS value FROM reviews
UNION ALL SELECT 'unique_apps', count(DISTINCT app_id) FROM reviews
UNION ALL SELECT 'unique_sentiments', count(DISTINCT sentiment) FROM reviews""", "reviews"))
def q_basic_summary(spark, sf):
    return P.basic_summary(reviews(spark, sf))


@register("missing_values", with_views(
    "SELECT " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in _REVIEW_COLS)
    + " FROM reviews", "reviews"))
def q_missing_values(spark, sf):
    return P.missing_values(reviews(spark, sf))


@register("missing_report", with_views("\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
    + (f"count(*) FILTER (WHERE trim({c}, {WS_SQL}) = '') AS blank_count" if c in _REVIEW_STRINGS
       else "CAST(0 AS BIGINT) AS blank_count")
    + " FROM reviews" for c in _REVIEW_COLS), "reviews"))
def q_missing_report(spark, sf):
    return P.missing_report(reviews(spark, sf))


@register("sentiment_share", with_views("""
SELECT sentiment, count(*) AS count, count(*) * 100.0 / sum(count(*)) OVER () AS percent
FROM reviews GROUP BY sentiment""", "reviews"))
def q_sentiment_share(spark, sf):
    return P.sentiment_share(reviews(spark, sf))


@register("score_distribution", with_views(
    "SELECT review_score, count(*) AS count FROM reviews GROUP BY review_score", "reviews"))
def q_score_distribution(spark, sf):
    return P.score_distribution(reviews(spark, sf))


_TOP_APPS_SQL = """
SELECT app_id, app_name, count(*) AS review_count, avg(review_votes) AS avg_review_votes
FROM reviews GROUP BY app_id, app_name
ORDER BY review_count DESC, app_id, app_name LIMIT {n}"""


@register("top_apps", with_views(_TOP_APPS_SQL.format(n=20), "reviews"))
def q_top_apps(spark, sf):
    return P.top_apps(reviews(spark, sf), 20)


@register("top_apps_n", with_views(_TOP_APPS_SQL.format(n=10), "reviews"))
def q_top_apps_n(spark, sf):
    return P.top_apps(reviews(spark, sf), 10)


_BY_VOTES = """
SELECT app_id, app_name, review_count, round(avg_review_votes, 3) AS avg_review_votes
FROM ({pool}) t
ORDER BY round(avg_review_votes, 3) DESC, review_count DESC, app_id LIMIT 5"""


@register("top_apps_by_votes", with_views(_BY_VOTES.format(pool=_TOP_APPS_SQL.format(n=1 << 62)), "reviews"))
def q_top_apps_by_votes(spark, sf):
    return P.top_apps_by_votes(reviews(spark, sf), 5)


@register("top_apps_by_votes_of_20", with_views(_BY_VOTES.format(pool=_TOP_APPS_SQL.format(n=20)), "reviews"))
def q_top_apps_by_votes_of_20(spark, sf):
    """The dashboard's form: the pick is made among the 20 most-reviewed apps."""
    return P.top_apps_by_votes(reviews(spark, sf), 5, candidates=20)


@register("hourly_trend", with_views(
    "SELECT date_trunc('hour', event_time) AS hour, count(*) AS count FROM activity GROUP BY 1",
    "activity"))
def q_hourly_trend(spark, sf):
    return P.hourly_trend(activity(spark, sf))


@register("text_length", with_views(
    "SELECT event_id, length(review_text) AS review_text_length FROM texts", "texts"))
def q_text_length(spark, sf):
    return P.text_length(texts(spark, sf, text="length")).select(
        "event_id", F.col("review_text_length").cast("long").alias("review_text_length"))


@register("text_length_summary", with_views("""
SELECT sentiment, count(*) AS review_count, avg(length(review_text)) AS avg_review_text_length
FROM reviews GROUP BY sentiment""", "reviews"))
def q_text_length_summary(spark, sf):
    return P.text_length_summary(reviews(spark, sf, text="length"))


@register("length_gap", with_views("""
SELECT avg(length(review_text)) FILTER (WHERE sentiment = 'negative') AS negative_avg_length,
       avg(length(review_text)) FILTER (WHERE sentiment = 'positive') AS positive_avg_length,
       avg(length(review_text)) FILTER (WHERE sentiment = 'negative')
     - avg(length(review_text)) FILTER (WHERE sentiment = 'positive') AS length_gap
FROM reviews""", "reviews"))
def q_length_gap(spark, sf):
    return P.length_gap(reviews(spark, sf, text="length"))


@register("length_stats", with_views("""
SELECT sentiment, count(length(review_text)) AS n, avg(length(review_text)) AS mean_length,
       stddev_samp(length(review_text)) AS std_length,
       quantile_cont(length(review_text), 0.5) AS median_length,
       quantile_cont(length(review_text), 0.75) AS p75_length
FROM reviews GROUP BY sentiment""", "reviews"))
def q_length_stats(spark, sf):
    return P.length_stats(reviews(spark, sf, text="length"))


@register("stored_length_stats", with_views("""
SELECT sentiment, count(length(t)) AS n, avg(length(t)) AS mean_length, stddev_samp(length(t)) AS std_length,
       quantile_cont(length(t), 0.5) AS median_length, quantile_cont(length(t), 0.75) AS p75_length
FROM (SELECT sentiment, coalesce(trim(review_text, """ + WS_SQL + """), '') AS t FROM reviews) s GROUP BY sentiment""", "reviews"))
def q_stored_length_stats(spark, sf):
    """Silver ingested in several batches: the report adds up the histograms stored
    beside each of them and reads no silver row."""
    from reviewlake.plans.ingest_q import ingest_in_batches
    counts = ingest_in_batches(spark, sf)
    return P.length_stats_of(P.merge_length_counts(read_length_counts(spark, counts)))


@register("length_quantiles", with_views("""
SELECT quantile_cont(length(review_text), 0.25) AS p25,
       quantile_cont(length(review_text), 0.5) AS p50,
       quantile_cont(length(review_text), 0.75) AS p75
FROM texts""", "texts"))
def q_length_quantiles(spark, sf):
    return P.length_quantiles(texts(spark, sf, text="length"))


@register("length_histogram", with_views("""
, b AS (SELECT min(length(review_text))::DOUBLE AS lo, max(length(review_text))::DOUBLE AS hi
        FROM reviews WHERE review_text IS NOT NULL)
, w AS (SELECT lo, greatest((hi - lo) / 60.0, 1e-12) AS width FROM b)
SELECT sentiment, bin, lo + bin * width AS bin_start, lo + (bin + 1) * width AS bin_end,
       count(*) AS count
FROM (SELECT r.sentiment, w.lo, w.width,
             CAST(least(floor((length(r.review_text) - w.lo) / w.width), 59) AS INTEGER) AS bin
      FROM reviews r, w WHERE r.review_text IS NOT NULL) x
GROUP BY sentiment, bin, lo, width""", "reviews").replace("\n, b AS", ", b AS", 1))
def q_length_histogram(spark, sf):
    return P.length_histogram(reviews(spark, sf, text="length"), 60)


@register("app_sentiment_share", with_views("""
SELECT app_name, positive, negative, positive + negative AS total,
       positive * 100.0 / (positive + negative) AS positive_pct,
       negative * 100.0 / (positive + negative) AS negative_pct
FROM (SELECT app_name, count(*) FILTER (WHERE sentiment = 'positive') AS positive,
             count(*) FILTER (WHERE sentiment = 'negative') AS negative
      FROM reviews GROUP BY app_name) t
WHERE positive + negative > 0
ORDER BY total DESC, app_name LIMIT 10""", "reviews"))
def q_app_sentiment_share(spark, sf):
    return P.app_sentiment_share(reviews(spark, sf), 10)


@register("votes_filter", with_views(
    "SELECT event_id, app_id, review_votes FROM reviews WHERE review_votes >= 0", "reviews"))
def q_votes_filter(spark, sf):
    return P.votes_filter(reviews(spark, sf)).select("event_id", "app_id", "review_votes")


@register("length_votes_trend", with_views("""
, f AS (SELECT regr_slope(review_votes::DOUBLE, length(review_text)::DOUBLE) AS slope,
               regr_intercept(review_votes::DOUBLE, length(review_text)::DOUBLE) AS intercept,
               min(length(review_text))::DOUBLE AS x_min, max(length(review_text))::DOUBLE AS x_max,
               count(*) AS n
        FROM reviews WHERE review_votes >= 0 AND review_text IS NOT NULL)
SELECT i, slope, intercept, x_min + i * ((x_max - x_min) / 99.0) AS x,
       intercept + slope * (x_min + i * ((x_max - x_min) / 99.0)) AS y_fit
FROM f, range(0, 100) r(i) WHERE n > 0""", "reviews").replace("\n, f AS", ", f AS", 1))
def q_length_votes_trend(spark, sf):
    return P.length_votes_trend(reviews(spark, sf, text="length"), 100)


@register("class_distribution", with_views(
    "SELECT sentiment AS label_text, count(*) AS count FROM reviews "
    "WHERE review_text IS NOT NULL AND sentiment IN ('negative', 'positive') GROUP BY 1",
    "reviews"))
def q_class_distribution(spark, sf):
    return P.class_distribution(model_frame(reviews(spark, sf)))



def _profile_sql() -> str:
    parts = ["SELECT 'total_rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM reviews",
             "SELECT 'unique_apps', CAST(count(DISTINCT app_id) AS DOUBLE) FROM reviews",
             "SELECT 'unique_sentiments', CAST(count(DISTINCT sentiment) AS DOUBLE) FROM reviews"]
    for c in _REVIEW_COLS:
        parts.append(f"SELECT 'null_{c}', CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) FROM reviews")
        if c in _REVIEW_STRINGS:
            parts.append(f"SELECT 'blank_{c}', CAST(count(*) FILTER (WHERE trim({c}, {WS_SQL}) = '') AS DOUBLE) "
                         "FROM reviews")
    for k in ("negative", "positive"):
        parts.append(f"SELECT 'rows_{k}', CAST(count(*) FILTER (WHERE sentiment = '{k}') AS DOUBLE) "
                     "FROM reviews")
        parts.append(f"SELECT 'avg_length_{k}', avg(length(review_text)) FILTER "
                     f"(WHERE sentiment = '{k}') FROM reviews")
    return with_views("\nUNION ALL\n".join(parts), "reviews")


@register("profile", _profile_sql())
def q_profile(spark, sf):
    """Every scalar profiling report in one scan of the review table."""
    return P.profile(reviews(spark, sf, text="flags"))
