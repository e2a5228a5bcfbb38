"""Evaluation on any (label, prediction, score) frame (section 2.5 / 2.7).

* Confusion counts come from one conditional aggregation over the fixed label
  grid, so empty cells are zeros by construction (no join, no cross join).
* Weighted precision/recall/F1 follow MLlib's ``MulticlassMetrics``.
* ROC needs a running sum in score order. A global ordered window would pull
  every distinct score into one task, so ``roc_table`` sums inside fixed score
  ranges of two sizes and adds the totals of the ranges above. Only
  ``roc_points`` sorts; AUC and thresholds aggregate the unsorted table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.schemas import SENTIMENTS


def _div0(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0 or null."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def with_prediction_text(scored: DataFrame, score_col: str = "score", threshold: float = 0.5,
                         label_col: str = "label", classes: list[str] = SENTIMENTS) -> DataFrame:
    """Adds label_text / prediction_text for a 0/1 label and a score threshold."""
    neg, pos = classes
    return (scored
            .withColumn("label_text", F.when(F.col(label_col) == 1, pos).otherwise(neg))
            .withColumn("prediction_text",
                        F.when(F.col(score_col) >= threshold, pos).otherwise(neg)))


def confusion_matrix(pred: DataFrame, label_col: str = "label_text",
                     pred_col: str = "prediction_text",
                     labels: list[str] = SENTIMENTS) -> DataFrame:
    """(label_text, prediction_text, count) for every label pair, zeros included."""
    cells = [(a, b) for a in labels for b in labels]
    aggs = [F.count(F.when((F.col(label_col) == a) & (F.col(pred_col) == b), 1)).alias(f"c{i}")
            for i, (a, b) in enumerate(cells)]
    grid = F.array(*[F.struct(F.lit(a).alias(label_col), F.lit(b).alias(pred_col), F.col(f"c{i}").alias("count"))
                     for i, (a, b) in enumerate(cells)])
    return (pred.agg(*aggs).select(F.inline(grid))
            .orderBy(label_col, pred_col))


def _binary_counts(pred: DataFrame, label_col: str, pred_col: str, positive: str) -> DataFrame:
    y = F.col(label_col) == positive
    p = F.col(pred_col) == positive
    return pred.agg(
        F.count(F.when(~y & ~p, 1)).alias("tn"), F.count(F.when(~y & p, 1)).alias("fp"),
        F.count(F.when(y & ~p, 1)).alias("fn"), F.count(F.when(y & p, 1)).alias("tp"))


def confusion_percent(pred: DataFrame, label_col: str = "label_text",
                      pred_col: str = "prediction_text", positive: str = "positive") -> DataFrame:
    """One row: TN, FP, FN, TP, total and each cell's percent of the total."""
    c = _binary_counts(pred, label_col, pred_col, positive)
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    out = c.withColumn("total", total)
    for k in ("tn", "fp", "fn", "tp"):
        out = out.withColumn(f"{k}_pct", _div0(F.col(k) * 100.0, F.col("total")))
    return out


def confusion_metrics(pred: DataFrame, label_col: str = "label_text",
                      pred_col: str = "prediction_text", positive: str = "positive") -> DataFrame:
    """One row of binary metrics from TN/FP/FN/TP; 0 when a denominator is 0."""
    c = _binary_counts(pred, label_col, pred_col, positive)
    tn, fp, fn, tp = (F.col(k) for k in ("tn", "fp", "fn", "tp"))
    precision = _div0(tp, tp + fp)
    recall = _div0(tp, tp + fn)
    return c.select(
        "tn", "fp", "fn", "tp",
        precision.alias("precision"), recall.alias("recall"),
        _div0(tn, tn + fp).alias("specificity"),
        _div0(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _div0(2 * precision * recall, precision + recall).alias("f1"),
        _div0(fp, fp + tn).alias("false_positive_rate"),
        _div0(fn, fn + tp).alias("false_negative_rate"))


def classification_metrics(pred: DataFrame, label_col: str = "label",
                           pred_col: str = "prediction", by: tuple[str, ...] = ()) -> DataFrame:
    """One row per ``by`` group: accuracy and MLlib-style weighted precision / recall / F1.

    Works for any number of classes: one aggregation to (label, prediction)
    counts (tiny), each counted once for its label and once for its prediction,
    then per-class sums. Classes are those seen as a label or a prediction;
    weights are the true-label frequencies. Without ``by`` there is always one
    row, zeros for no input; any number of groups costs one pass.
    """
    pairs = pred.groupBy(*by, F.col(label_col).alias("y"), F.col(pred_col).alias("p")).agg(
        F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("y").cast("string").alias("k"), F.col("n").alias("actual"), zero.alias("predicted"),
                 F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(zero).alias("tp")),
        F.struct(F.col("p").cast("string").alias("k"), zero.alias("actual"), F.col("n").alias("predicted"), zero.alias("tp")))
    # label and prediction may be of different types (an int and a double): compare them as one
    same = pairs.withColumns({"y": F.col("y").cast("double"), "p": F.col("p").cast("double")}) if _numeric(
        pred, label_col, pred_col) else pairs
    per_k = (same.select(*by, F.inline(sides)).groupBy(*by, "k")
             .agg(F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp")))
    precision = _div0(F.col("tp"), F.col("predicted"))
    recall = _div0(F.col("tp"), F.col("actual"))
    f1 = _div0(2 * precision * recall, precision + recall)
    total = F.sum("actual")
    return per_k.groupBy(*by).agg(
        _div0(F.sum("tp"), total).alias("accuracy"),
        _div0(F.sum(F.col("actual") * f1), total).alias("f1_score"),
        _div0(F.sum(F.col("actual") * precision), total).alias("weighted_precision"),
        _div0(F.sum(F.col("actual") * recall), total).alias("weighted_recall"))


def _numeric(df: DataFrame, *cols: str) -> bool:
    return all(isinstance(df.select(c).schema[0].dataType, T.NumericType) for c in cols)


def roc_table(scored: DataFrame, label_col: str = "label", score_col: str = "score",
              bins: int | None = None, with_origin: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, score, pos, neg, tp, fp, tpr, fpr) per distinct score, in no order.

    ``tp``/``fp`` count rows with score >= this score. ``bins`` first rounds
    scores down to ``bins`` equal-width steps of [0, 1]; ``with_origin`` adds
    the (0, 0) point (score null). ``by`` names never-null columns whose groups
    (models, thresholds, score kinds) each get their own curve in the same pass.

    The running sum goes by two levels of score ranges that depend on the
    score alone: a score's place in [0, 1] is cut at 16 and at 32 bits. Each
    window orders the scores of a fine range, the fine ranges of a coarse one
    (65,536 at most) or the coarse ranges (as many), whatever the data size.
    """
    s = F.col(score_col).cast("double")
    if bins:
        s = F.least(F.floor(s * bins), F.lit(bins - 1)) / F.lit(float(bins))
    y = F.col(label_col).cast("double") == 1.0
    agg = (scored.where(F.col(score_col).isNotNull() & F.col(label_col).isNotNull())
           .groupBy(*by, s.alias("score"))
           .agg(F.count(F.when(y, 1)).alias("pos"), F.count(F.when(~y, 1)).alias("neg")))
    place = (F.col("score") / (1 + F.abs("score")) + 1) / 2        # grows with the score
    finite = F.abs("score") < float("inf")                         # NaN is larger than infinity
    fine = (F.when(finite, F.floor(place * float(1 << 32)))
            .when(F.col("score") > 0, F.lit(1 << 32)).otherwise(F.lit(-1)).cast("long"))
    leaf = agg.withColumn("__f", fine).withColumn("__c", F.shiftright("__f", 16))

    def above(w) -> tuple:
        return tuple((F.sum(c).over(w) - F.col(c)) for c in ("__p", "__n"))

    per_fine = leaf.groupBy(*by, "__c", "__f").agg(F.sum("pos").alias("__p"), F.sum("neg").alias("__n"))
    per_coarse = per_fine.groupBy(*by, "__c").agg(F.sum("__p").alias("__p"), F.sum("__n").alias("__n"))
    frame = (Window.unboundedPreceding, 0)
    p1, n1 = above(Window.partitionBy(*by).orderBy(F.desc("__c")).rowsBetween(*frame))
    p2, n2 = above(Window.partitionBy(*by, "__c").orderBy(F.desc("__f")).rowsBetween(*frame))
    whole = Window.partitionBy(*by)
    coarse = per_coarse.select(*by, "__c", p1.alias("__p1"), n1.alias("__n1"), F.sum("__p").over(whole).alias("__P"),
                               F.sum("__n").over(whole).alias("__N"))
    offsets = per_fine.select(*by, "__c", "__f", p2.alias("__p2"), n2.alias("__n2")).join(coarse, [*by, "__c"]).select(
        *by, "__f", (F.col("__p1") + F.col("__p2")).alias("__op"), (F.col("__n1") + F.col("__n2")).alias("__on"),
        "__P", "__N")
    inside = Window.partitionBy(*by, "__f").orderBy(F.desc("score")).rowsBetween(*frame)
    pts = (leaf.select(*by, "__f", "score", "pos", "neg", F.sum("pos").over(inside).alias("tp"),
                       F.sum("neg").over(inside).alias("fp"))
           .join(offsets, [*by, "__f"])
           .select(*by, "score", "pos", "neg", (F.col("tp") + F.col("__op")).alias("tp"),
                   (F.col("fp") + F.col("__on")).alias("fp"), "__P", "__N"))
    if with_origin:
        # one row a group carrying the class totals (none for empty input)
        zero = F.lit(0).cast("long")
        origin = (coarse.groupBy(*by).agg(F.max("__P").alias("__P"), F.max("__N").alias("__N"))
                  .where(F.col("__P").isNotNull())
                  .select(*by, F.lit(None).cast("double").alias("score"), zero.alias("pos"), zero.alias("neg"),
                          zero.alias("tp"), zero.alias("fp"), "__P", "__N"))
        pts = pts.unionByName(origin)
    return (pts.withColumn("tpr", F.try_divide(F.col("tp").cast("double"), F.col("__P").cast("double")))
            .withColumn("fpr", F.try_divide(F.col("fp").cast("double"), F.col("__N").cast("double")))
            .drop("__P", "__N"))


def roc_points(scored: DataFrame, label_col: str = "label", score_col: str = "score",
               bins: int | None = None, with_origin: bool = True, by: tuple[str, ...] = ()) -> DataFrame:
    """``roc_table`` with its origin, by group and descending score: for output."""
    return roc_table(scored, label_col, score_col, bins, with_origin, by).orderBy(*by, F.desc_nulls_first("score"))


def auc(scored: DataFrame, label_col: str = "label", score_col: str = "score", by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, area_under_roc): trapezoid area = rank-sum form, ties counted half.

    One row, or one per ``by`` group. Null when one class is absent.
    """
    pts = roc_table(scored, label_col, score_col, by=by)
    num = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0))
    den = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return pts.groupBy(*by).agg(F.try_divide(num, den).alias("area_under_roc"))


def evaluate_groups(pred: DataFrame, by: tuple[str, ...] = ("model_name",), label_col: str = "label",
                    pred_col: str = "prediction", score_col: str = "score") -> DataFrame:
    """(*by, the five metrics): any number of models, thresholds or kinds in one pass each
    over their stacked predictions; a group without both classes has a null AUC."""
    m = classification_metrics(pred, label_col, pred_col, by)
    return m.join(auc(pred, label_col, score_col, by), list(by), "left")


def threshold_metrics(scored: DataFrame, thresholds: dict[str, float], label_col: str = "label",
                      score_col: str = "score", name_col: str = "model_name") -> DataFrame:
    """(name, the five metrics) of each named score threshold.

    One aggregate counts labels against all thresholds at once; the AUC doesn't
    depend on the threshold and is computed once. Rows without a score count as
    below every threshold. Empty input: a row of zeros each, AUC null.
    """
    names = list(thresholds)
    y = F.col(label_col).cast("double") == 1.0
    over = [F.coalesce(F.col(score_col) >= F.lit(thresholds[n]), F.lit(False)) for n in names]
    counts = scored.where(F.col(label_col).isNotNull()).agg(
        F.count(F.when(y, 1)).cast("double").alias("P"), F.count(F.when(~y, 1)).cast("double").alias("N"),
        *[F.count(F.when(y & o, 1)).cast("double").alias(f"tp{i}") for i, o in enumerate(over)],
        *[F.count(F.when(~y & o, 1)).cast("double").alias(f"fp{i}") for i, o in enumerate(over)])
    rows = counts.select("P", "N", F.inline(F.array(*[F.struct(
        F.lit(n).alias(name_col), F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp")) for i, n in enumerate(names)])))
    tp, fp, pos, neg = (F.col(c) for c in ("tp", "fp", "P", "N"))
    per_class = [(pos, tp, tp + fp), (neg, neg - fp, pos + neg - tp - fp)]     # actual, hit, predicted
    total = pos + neg
    precision = [_div0(hit, predicted) for _, hit, predicted in per_class]
    recall = [_div0(hit, actual) for actual, hit, _ in per_class]
    f1 = [_div0(2 * p * r, p + r) for p, r in zip(precision, recall)]

    def weighted(values: list[Column]) -> Column:
        return _div0(sum((a * v for (a, *_), v in zip(per_class, values)), F.lit(0.0)), total)
    area = auc(scored, label_col, score_col)
    return rows.select(
        name_col, _div0(tp + neg - fp, total).alias("accuracy"), weighted(f1).alias("f1_score"),
        weighted(precision).alias("weighted_precision"), weighted(recall).alias("weighted_recall"),
        area.scalar().alias("area_under_roc"))


def evaluate(pred: DataFrame, label_col: str = "label", pred_col: str = "prediction",
             score_col: str = "score") -> DataFrame:
    """(metric, value): accuracy, f1_score, weighted_precision, weighted_recall, area_under_roc."""
    m = classification_metrics(pred, label_col, pred_col)
    a = auc(pred, label_col, score_col)
    wide = m.select("*", a.scalar().alias("area_under_roc"))
    names = ["accuracy", "f1_score", "weighted_precision", "weighted_recall", "area_under_roc"]
    args = ", ".join(f"'{n}', `{n}`" for n in names)
    return wide.select(F.expr(f"stack({len(names)}, {args}) AS (`metric`, `value`)"))


def youden_threshold(roc: DataFrame) -> DataFrame:
    """The ROC point maximising TPR - FPR; ties go to the highest score."""
    j = F.col("tpr") - F.col("fpr")
    return (roc.withColumn("youden_j", j)
            .orderBy(F.desc_nulls_last("youden_j"), F.desc_nulls_first("score"))
            .limit(1))


def threshold_points(roc: DataFrame, targets: tuple[float, ...] = (0.3, 0.5, 0.7)) -> DataFrame:
    """(target, score, fpr, tpr): the point whose score is nearest each target.

    One aggregation with one ``min_by`` per target (no join); ties -> higher score.
    """
    pts = roc.where(F.col("score").isNotNull())
    aggs = [F.min_by(F.struct("score", "fpr", "tpr"),
                     F.struct(F.abs(F.col("score") - F.lit(t)), -F.col("score"))).alias(f"t{i}")
            for i, t in enumerate(targets)]
    args = ", ".join(f"CAST({t} AS DOUBLE), t{i}" for i, t in enumerate(targets))
    return (pts.agg(*aggs)
            .select(F.expr(f"stack({len(targets)}, {args}) AS (`target`, `p`)"))
            .select("target", "p.score", "p.fpr", "p.tpr"))


def score_histogram(scored: DataFrame, bins: int = 30, label_col: str = "label",
                    score_col: str = "score") -> DataFrame:
    """(label, bin, bin_start, count): fixed equal-width bins over [0, 1]."""
    b = F.least(F.greatest(F.floor(F.col(score_col) * bins), F.lit(0)), F.lit(bins - 1)).cast("int")
    return (scored.where(F.col(score_col).isNotNull())
            .groupBy(label_col, b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("count"))
            .withColumn("bin_start", F.col("bin") / F.lit(float(bins)))
            .orderBy(label_col, "bin"))


def prediction_distribution(pred: DataFrame, pred_col: str = "prediction_text") -> DataFrame:
    """(prediction_text, count)."""
    return pred.groupBy(pred_col).agg(F.count(F.lit(1)).alias("count")).orderBy(pred_col)


def sample_predictions(pred: DataFrame, n: int = 5, key: str = "event_id",
                       label_col: str = "label_text", pred_col: str = "prediction_text") -> DataFrame:
    """``n`` correct and ``n`` wrong predictions, lowest ``key`` first (bounded top-k)."""
    ok = F.col(label_col) == F.col(pred_col)
    right = pred.where(ok).orderBy(key).limit(n).withColumn("correct", F.lit(True))
    wrong = pred.where(~ok).orderBy(key).limit(n).withColumn("correct", F.lit(False))
    return right.unionByName(wrong)
