"""Report shaping over result-sized frames (model comparison, feature tables).

These run on frames with one row per model, metric or feature; they are short
DataFrame expressions so a report is computed where its input lives.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.operators.clean import map_values
from reviewlake.schemas import METRIC_LABELS, MODEL_SHORT_NAMES

# Comparison metric columns, in display order.
METRICS = ["accuracy", "f1_score", "weighted_precision", "weighted_recall", "area_under_roc"]


def union_classes(*frames: DataFrame) -> DataFrame:
    """Union by column name, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def concat_results(frames: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Stack per-model / per-file frames (``unionByName``)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def rank_models(comparison: DataFrame, metric: str = "f1_score",
                name_col: str = "model_name") -> DataFrame:
    """Models ordered by ``metric`` (desc, then name) with 1-based ``rank`` and ``is_best``.

    ``metric="f1_score"`` is the training job's rule, ``"area_under_roc"`` the
    dashboard's; the choice is explicit.
    """
    w = Window.orderBy(F.desc_nulls_last(metric), F.asc(name_col))
    return (comparison.withColumn("rank", F.row_number().over(w).cast("long"))
            .withColumn("is_best", F.col("rank") == 1)
            .orderBy("rank"))


def melt_metrics(comparison: DataFrame, metrics: list[str] = METRICS,
                 name_col: str = "model_name") -> DataFrame:
    """Wide comparison -> (model_name, metric, score, metric_order)."""
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"`{m}`").cast("double").alias("score"),
                               F.lit(i).alias("metric_order")) for i, m in enumerate(metrics)])
    return comparison.select(name_col, F.inline(cells))


def display_names(melted: DataFrame, name_col: str = "model_name") -> DataFrame:
    """``melt_metrics`` plus metric_label and model_short; a model without a short name keeps its own."""
    return melted.withColumns({"metric_label": map_values("metric", METRIC_LABELS, "metric"),
                               "model_short": map_values(name_col, MODEL_SHORT_NAMES, name_col)})


def metric_winners(comparison: DataFrame, metrics: list[str] = METRICS,
                   name_col: str = "model_name") -> DataFrame:
    """(metric, best_model, best_score) per metric column; ties -> first name."""
    long = melt_metrics(comparison, metrics, name_col)
    return (long.groupBy("metric", "metric_order")
            .agg(F.min_by(F.struct(name_col, "score"),
                          F.struct(-F.col("score"), F.col(name_col))).alias("w"))
            .select("metric", F.col(f"w.{name_col}").alias("best_model"),
                    F.col("w.score").alias("best_score"), "metric_order")
            .orderBy("metric_order"))


def pivot_counts(confusion: DataFrame, labels: list[str], label_col: str = "label_text",
                 pred_col: str = "prediction_text", count_col: str = "count") -> DataFrame:
    """Long confusion counts -> one row per label, one column per predicted label, 0-filled."""
    return (confusion.groupBy(label_col).pivot(pred_col, labels).agg(F.sum(count_col))
            .fillna(0, subset=labels).orderBy(label_col))


def top_features_n(importance: DataFrame, n: int = 20) -> DataFrame:
    """Top ``n`` features by absolute importance, sign kept; ties (at nine digits) by feature name."""
    return (importance.withColumn("abs_importance", F.abs("importance"))
            .orderBy(F.desc(F.round("abs_importance", 9)), F.asc("feature")).limit(n))


def signed_features(importance: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most positive and ``n`` most negative features."""
    pos = (importance.where(F.col("importance") > 0)
           .orderBy(F.desc(F.round("importance", 9)), "feature").limit(n).withColumn("direction", F.lit("positive")))
    neg = (importance.where(F.col("importance") < 0)
           .orderBy(F.asc(F.round("importance", 9)), "feature").limit(n).withColumn("direction", F.lit("negative")))
    return pos.unionByName(neg)


def top_features_per_model(importance: DataFrame, n: int = 5,
                           name_col: str = "model_name") -> DataFrame:
    """(model_name, top_features): the ``n`` strongest features joined with ', '."""
    w = Window.partitionBy(name_col).orderBy(F.desc(F.round(F.abs("importance"), 9)), F.asc("feature"))
    top = importance.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n)
    return (top.groupBy(name_col)
            .agg(F.sort_array(F.collect_list(F.struct("__rn", "feature"))).alias("__f"))
            .select(name_col, F.array_join(F.transform("__f", lambda s: s["feature"]), ", ")
                    .alias("top_features"))
            .orderBy(name_col))
