"""Evaluation queries on the model-free ``scored`` view and report shaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlake.operators import evaluate as V
from reviewlake.operators import reports as R
from reviewlake.plans.registry import register, with_views
from reviewlake.sources.tables import scored

_PRED = ("SELECT event_id, label, score, "
         "CASE WHEN label = 1 THEN 'positive' ELSE 'negative' END AS label_text, "
         "CASE WHEN score >= {t} THEN 'positive' ELSE 'negative' END AS prediction_text, "
         "CASE WHEN score >= {t} THEN 1.0 ELSE 0.0 END AS prediction FROM scored")

_ROC = """
roc_agg AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos,
                   count(*) FILTER (WHERE label <> 1) AS neg
            FROM scored WHERE score IS NOT NULL AND label IS NOT NULL GROUP BY score),
roc_tot AS (SELECT CAST(sum(pos) AS DOUBLE) AS P, CAST(sum(neg) AS DOUBLE) AS N FROM roc_agg),
roc_cum AS (SELECT score, pos, neg,
                   CAST(sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tp,
                   CAST(sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fp
            FROM roc_agg),
roc AS (SELECT score, pos, neg, tp, fp, tp / P AS tpr, fp / N AS fpr FROM roc_cum, roc_tot
        UNION ALL SELECT NULL, 0, 0, 0, 0, 0.0, 0.0)"""


def _pred(spark, sf, t: float = 0.5):
    s = V.with_prediction_text(scored(spark, sf), "score", t)
    return s.withColumn("prediction", F.when(F.col("score") >= t, 1.0).otherwise(0.0))


def _w(sql: str, *extra: str) -> str:
    """``with_views`` for ``scored`` plus extra CTE text."""
    body = with_views(sql, "scored")
    if extra:
        head, rest = body.split("\n", 1)
        # insert the extra CTEs after the scored view definition
        idx = rest.index(")\n") + 1
        body = head + "\n" + rest[:idx] + "," + ",".join(extra) + rest[idx:]
    return body


@register("confusion_matrix", _w(f"""
SELECT l.label_text, p.prediction_text,
       count(x.event_id) AS count
FROM (VALUES ('negative'), ('positive')) l(label_text)
CROSS JOIN (VALUES ('negative'), ('positive')) p(prediction_text)
LEFT JOIN ({_PRED.format(t=0.5)}) x
  ON x.label_text = l.label_text AND x.prediction_text = p.prediction_text
GROUP BY 1, 2"""))
def q_confusion_matrix(spark, sf):
    return V.confusion_matrix(_pred(spark, sf))


@register("pivot_counts", _w(f"""
SELECT label_text,
       count(*) FILTER (WHERE prediction_text = 'negative') AS negative,
       count(*) FILTER (WHERE prediction_text = 'positive') AS positive
FROM ({_PRED.format(t=0.5)}) x GROUP BY label_text"""))
def q_pivot_counts(spark, sf):
    labels = ["negative", "positive"]
    return R.pivot_counts(V.confusion_matrix(_pred(spark, sf)), labels)


_COUNTS = f"""
SELECT count(*) FILTER (WHERE label_text = 'negative' AND prediction_text = 'negative') AS tn,
       count(*) FILTER (WHERE label_text = 'negative' AND prediction_text = 'positive') AS fp,
       count(*) FILTER (WHERE label_text = 'positive' AND prediction_text = 'negative') AS fn,
       count(*) FILTER (WHERE label_text = 'positive' AND prediction_text = 'positive') AS tp
FROM ({_PRED.format(t=0.5)}) x"""


def _d0(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / ({b}) END"


@register("confusion_percent", _w(f"""
SELECT tn, fp, fn, tp, tn + fp + fn + tp AS total,
       {_d0('tn * 100.0', 'tn + fp + fn + tp')} AS tn_pct,
       {_d0('fp * 100.0', 'tn + fp + fn + tp')} AS fp_pct,
       {_d0('fn * 100.0', 'tn + fp + fn + tp')} AS fn_pct,
       {_d0('tp * 100.0', 'tn + fp + fn + tp')} AS tp_pct
FROM ({_COUNTS}) c"""))
def q_confusion_percent(spark, sf):
    return V.confusion_percent(_pred(spark, sf))


@register("confusion_metrics", _w(f"""
SELECT tn, fp, fn, tp, precision, recall, specificity, accuracy,
       {_d0('2 * precision * recall', 'precision + recall')} AS f1,
       false_positive_rate, false_negative_rate
FROM (SELECT tn, fp, fn, tp, {_d0('tp', 'tp + fp')} AS precision, {_d0('tp', 'tp + fn')} AS recall,
             {_d0('tn', 'tn + fp')} AS specificity, {_d0('tp + tn', 'tp + tn + fp + fn')} AS accuracy,
             {_d0('fp', 'fp + tn')} AS false_positive_rate,
             {_d0('fn', 'fn + tp')} AS false_negative_rate
      FROM ({_COUNTS}) c) m"""))
def q_confusion_metrics(spark, sf):
    return V.confusion_metrics(_pred(spark, sf))


@register("prediction_distribution", _w(f"""
SELECT prediction_text, count(*) AS count FROM ({_PRED.format(t=0.5)}) x GROUP BY 1"""))
def q_prediction_distribution(spark, sf):
    return V.prediction_distribution(_pred(spark, sf))


@register("sample_predictions", _w(f"""
SELECT event_id, label_text, prediction_text, correct FROM (
  SELECT *, label_text = prediction_text AS correct,
         row_number() OVER (PARTITION BY label_text = prediction_text ORDER BY event_id) AS rn
  FROM ({_PRED.format(t=0.5)}) x) t WHERE rn <= 5"""))
def q_sample_predictions(spark, sf):
    return V.sample_predictions(_pred(spark, sf), 5).select(
        "event_id", "label_text", "prediction_text", "correct")


@register("roc_points", _w("SELECT * FROM roc", _ROC))
def q_roc_points(spark, sf):
    return V.roc_points(scored(spark, sf), "label", "score")


@register("auc", _w("""
SELECT sum(neg * (tp - pos / 2.0)) / (sum(pos) * sum(neg)) AS area_under_roc
FROM roc WHERE score IS NOT NULL""", _ROC))
def q_auc(spark, sf):
    return V.auc(scored(spark, sf), "label", "score")


@register("youden_threshold", _w("""
SELECT *, tpr - fpr AS youden_j FROM roc
ORDER BY youden_j DESC NULLS LAST, score DESC NULLS FIRST LIMIT 1""", _ROC))
def q_youden_threshold(spark, sf):
    return V.youden_threshold(V.roc_table(scored(spark, sf), with_origin=True))


@register("threshold_points", _w("""
SELECT target, score, fpr, tpr FROM (
  SELECT t.target, r.score, r.fpr, r.tpr,
         row_number() OVER (PARTITION BY t.target ORDER BY abs(r.score - t.target), r.score DESC) AS rn
  FROM roc r, (VALUES (CAST(0.3 AS DOUBLE)), (CAST(0.5 AS DOUBLE)), (CAST(0.7 AS DOUBLE))) t(target)
  WHERE r.score IS NOT NULL) x WHERE rn = 1""", _ROC))
def q_threshold_points(spark, sf):
    return V.threshold_points(V.roc_table(scored(spark, sf)))


@register("score_histogram", _w("""
SELECT label, CAST(least(greatest(floor(score * 30), 0), 29) AS INTEGER) AS bin, count(*) AS count,
       CAST(least(greatest(floor(score * 30), 0), 29) AS INTEGER) / 30.0 AS bin_start
FROM scored WHERE score IS NOT NULL GROUP BY 1, 2"""))
def q_score_histogram(spark, sf):
    return V.score_histogram(scored(spark, sf), 30)


def _metrics_sql(t: float, name: str) -> str:
    pred = _PRED.format(t=t)
    return f"""
SELECT '{name}' AS model_name, *
FROM (
  SELECT {_d0('sum(tp)', 'sum(actual)')} AS accuracy,
         {_d0('sum(actual * f1)', 'sum(actual)')} AS f1_score,
         {_d0('sum(actual * prec)', 'sum(actual)')} AS weighted_precision,
         {_d0('sum(actual * rec)', 'sum(actual)')} AS weighted_recall
  FROM (SELECT *, {_d0('2 * prec * rec', 'prec + rec')} AS f1
        FROM (SELECT actual, tp, {_d0('tp', 'predicted')} AS prec, {_d0('tp', 'actual')} AS rec
              FROM (SELECT coalesce(a.k, b.k) AS k, coalesce(a.actual, 0) AS actual,
                           coalesce(b.predicted, 0) AS predicted, coalesce(a.tp, 0) AS tp
                    FROM (SELECT label AS k, count(*) AS actual,
                                 count(*) FILTER (WHERE label = prediction) AS tp
                          FROM ({pred}) x GROUP BY label) a
                    FULL JOIN (SELECT prediction AS k, count(*) AS predicted
                               FROM ({pred}) x GROUP BY prediction) b
                    ON a.k = b.k) pk) m) f) w,
(SELECT sum(neg * (tp - pos / 2.0)) / (sum(pos) * sum(neg)) AS area_under_roc
 FROM roc WHERE score IS NOT NULL) a"""


_NAMES = {0.3: "threshold_0.3", 0.5: "threshold_0.5", 0.7: "threshold_0.7"}
_COMPARISON_SQL = "\nUNION ALL\n".join(_metrics_sql(t, n) for t, n in _NAMES.items())


@register("evaluate", _w("""
SELECT metric, value FROM (""" + _metrics_sql(0.5, "m") + """) w
UNPIVOT (value FOR metric IN (accuracy, f1_score, weighted_precision, weighted_recall,
                              area_under_roc))""", _ROC))
def q_evaluate(spark, sf):
    return V.evaluate(_pred(spark, sf), "label", "prediction", "score")


def comparison(spark, sf):
    """Wide comparison of three score thresholds (the report-op input)."""
    return V.threshold_metrics(scored(spark, sf), {name: t for t, name in _NAMES.items()})


@register("compare_thresholds", _w(f"SELECT * FROM ({_COMPARISON_SQL}) c", _ROC))
def q_compare_thresholds(spark, sf):
    return comparison(spark, sf)


@register("rank_models", _w(f"""
SELECT *, row_number() OVER (ORDER BY f1_score DESC NULLS LAST, model_name) AS rank,
       row_number() OVER (ORDER BY f1_score DESC NULLS LAST, model_name) = 1 AS is_best
FROM ({_COMPARISON_SQL}) c""", _ROC))
def q_rank_models(spark, sf):
    return R.rank_models(comparison(spark, sf), "f1_score")


@register("melt_metrics", _w(f"""
SELECT model_name, metric, score,
       CASE metric WHEN 'accuracy' THEN 0 WHEN 'f1_score' THEN 1 WHEN 'weighted_precision' THEN 2
                   WHEN 'weighted_recall' THEN 3 ELSE 4 END AS metric_order
FROM ({_COMPARISON_SQL}) c
UNPIVOT (score FOR metric IN (accuracy, f1_score, weighted_precision, weighted_recall,
                              area_under_roc))""", _ROC))
def q_melt_metrics(spark, sf):
    return R.melt_metrics(comparison(spark, sf))


@register("display_names", _w(f"""
SELECT model_name, metric, score,
       CASE metric WHEN 'accuracy' THEN 0 WHEN 'f1_score' THEN 1 WHEN 'weighted_precision' THEN 2
                   WHEN 'weighted_recall' THEN 3 ELSE 4 END AS metric_order,
       CASE metric WHEN 'accuracy' THEN 'Accuracy' WHEN 'f1_score' THEN 'F1-Score'
                   WHEN 'weighted_precision' THEN 'Precision' WHEN 'weighted_recall' THEN 'Recall'
                   ELSE 'AUC-ROC' END AS metric_label,
       model_name AS model_short
FROM ({_COMPARISON_SQL}) c
UNPIVOT (score FOR metric IN (accuracy, f1_score, weighted_precision, weighted_recall,
                              area_under_roc))""", _ROC))
def q_display_names(spark, sf):
    return R.display_names(R.melt_metrics(comparison(spark, sf)))


@register("metric_winners", _w(f"""
SELECT metric, best_model, best_score, metric_order FROM (
  SELECT metric, model_name AS best_model, score AS best_score,
         CASE metric WHEN 'accuracy' THEN 0 WHEN 'f1_score' THEN 1 WHEN 'weighted_precision' THEN 2
                     WHEN 'weighted_recall' THEN 3 ELSE 4 END AS metric_order,
         row_number() OVER (PARTITION BY metric ORDER BY score DESC, model_name) AS rn
  FROM ({_COMPARISON_SQL}) c
  UNPIVOT (score FOR metric IN (accuracy, f1_score, weighted_precision, weighted_recall,
                                area_under_roc))) x WHERE rn = 1""", _ROC))
def q_metric_winners(spark, sf):
    return R.metric_winners(comparison(spark, sf))
