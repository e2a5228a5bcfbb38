"""The regularised logistic loss's gradient as one distributed aggregate.

A fitted logistic regression is proved by its own condition: at the minimum the
gradient of the loss it was fitted to is zero in every coordinate. Residuals
are row-local; each stored feature of a row adds residual * value to its slot,
partially aggregated per task, so one row a slot and task is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def slot_sums(features: DataFrame, features_col: str = "features", keep: tuple[str, ...] = ()) -> DataFrame:
    """(*keep, index, value): a sparse vector column's entries as rows."""
    v = F.unwrap_udt(features_col)
    index = F.coalesce(v["indices"], F.transform(v["values"], lambda _, i: i))
    cells = F.arrays_zip(index.alias("index"), v["values"].alias("value"))
    return features.select(*keep, F.inline(cells))


def logistic_gradient(scored: DataFrame, coefficients: DataFrame, reg: float, label_col: str = "label",
                      probability_col: str = "probability", features_col: str = "features",
                      weight_col: str | None = None) -> DataFrame:
    """(index, coefficient, weight_0, weight_1, gradient) of every slot that has a value.

    ``scored`` has one row a training document: 0/1 label, the fitted positive
    probability and the feature vector; ``coefficients`` (index, value) are the
    model's. The loss is MLlib's: mean weighted log loss plus reg / 2 times the
    squared coefficients *of scaled features* (each divided by its sample
    deviation); ``gradient`` is in that scale too. ``weight_0``/``weight_1``
    add up the slot's values by label. The slot -1 is the intercept.
    """
    w = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    y = F.col(label_col).cast("double")
    rows = scored.select(y.alias("y"), w.alias("w"), (w * (F.col(probability_col) - y)).alias("r"), features_col)
    n = rows.agg(F.sum("w").alias("n"), F.sum("r").alias("r"), F.sum(F.col("w") * F.col("w")).alias("n2"),
                 F.sum(F.when(F.col("y") == 0, F.col("w"))).alias("n0"), F.sum(F.when(F.col("y") == 1, F.col("w"))).alias("n1"))
    x = F.col("value")
    sums = (slot_sums(rows, features_col, ("y", "w", "r")).groupBy("index")
            .agg(F.sum(F.col("r") * x).alias("rx"), F.sum(F.col("w") * x).alias("wx"), F.sum(F.col("w") * x * x).alias("wx2"),
                 F.sum(F.when(F.col("y") == 0, F.col("w") * x)).alias("w0"), F.sum(F.when(F.col("y") == 1, F.col("w") * x)).alias("w1")))
    total, squares = n.select("n").scalar(), n.select("n2").scalar()
    # weighted sample variance, as the fit scales by
    var = (F.col("wx2") - F.col("wx") * F.col("wx") / total) / (total - squares / total)
    sd = F.sqrt(F.greatest(var, F.lit(0.0)))
    joined = sums.join(F.broadcast(coefficients.withColumnRenamed("value", "coefficient")), "index", "left").withColumn(
        "coefficient", F.coalesce("coefficient", F.lit(0.0)))
    slots = joined.select(
        "index", "coefficient", F.coalesce("w0", F.lit(0.0)).alias("weight_0"), F.coalesce("w1", F.lit(0.0)).alias("weight_1"),
        # a slot of one value for all rows has no scale and no coefficient
        F.when(sd > 0, F.col("rx") / total / sd + reg * sd * F.col("coefficient")).otherwise(0.0).alias("gradient"))
    intercept = n.select(F.lit(-1).alias("index"), F.lit(None).cast("double").alias("coefficient"), F.col("n0").alias("weight_0"),
                         F.col("n1").alias("weight_1"), (F.col("r") / F.col("n")).alias("gradient"))
    return slots.unionByName(intercept)
