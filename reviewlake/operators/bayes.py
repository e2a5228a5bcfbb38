"""Multinomial Naive Bayes as relations: priors, weights by term, posteriors.

The same model as MLlib's ``NaiveBayes`` on tf-idf, written as tables: the
class log-priors (one row a class), ``features.nb_theta`` (class, term) and a
posterior that sums tf-idf times theta over a document's terms. A document's
term rows come from one task and collapse before the only shuffle, which moves
one row a document; theta is bounded by the vocabulary and broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nb_prior(docs: DataFrame, label_col: str = "label", smoothing: float = 1.0,
             classes: tuple[int, ...] = (0, 1)) -> DataFrame:
    """(label, prior): ln((n_c + s) / (n + s * classes)) from one conditional aggregate."""
    n = F.count(F.lit(1)) + smoothing * len(classes)
    rows = F.array(*[F.struct(
        F.lit(c).alias(label_col),
        F.log((F.count(F.when(F.col(label_col) == c, 1)) + smoothing) / n).alias("prior")) for c in classes])
    return docs.agg(rows.alias("r")).select(F.inline("r"))


def nb_posterior(weights: DataFrame, docs: DataFrame, theta: DataFrame, prior: DataFrame,
                 doc_col: str = "event_id", label_col: str = "label",
                 classes: tuple[int, int] = (0, 1)) -> DataFrame:
    """(doc, raw_0, raw_1, probability, prediction) for every row of ``docs``.

    ``weights`` (doc, term, weight) are the tf-idf rows of the documents to
    score, with the *training* idf. raw_c = prior + sum of weight * theta;
    probability is that of the second class, prediction its index, the first
    class on ties. A document without vocabulary terms has the priors alone.
    """
    wide = theta.groupBy("term").agg(*[
        F.max(F.when(F.col(label_col) == c, F.col("theta"))).alias(f"t{i}") for i, c in enumerate(classes)])
    sums = (weights.join(F.broadcast(wide), "term")
            .groupBy(doc_col).agg(*[F.sum(F.col("weight") * F.col(f"t{i}")).alias(f"s{i}") for i in range(2)]))
    p = prior.agg(*[F.max(F.when(F.col(label_col) == c, F.col("prior"))).alias(f"p{i}") for i, c in enumerate(classes)])
    raw = [(F.coalesce(f"s{i}", F.lit(0.0)) + p.select(f"p{i}").scalar()).alias(f"raw_{i}") for i in range(2)]
    return (docs.select(doc_col).join(sums, doc_col, "left").select(doc_col, *raw)
            .withColumn("probability", 1 / (1 + F.exp(F.col("raw_0") - F.col("raw_1"))))
            .withColumn("prediction", F.when(F.col("raw_1") > F.col("raw_0"), 1.0).otherwise(0.0)))


def nb_importance(theta: DataFrame, model_name: str, top: int = 30, label_col: str = "label",
                  classes: tuple[int, int] = (0, 1)) -> DataFrame:
    """(model_name, feature, importance): the ``top`` terms by |theta_1 - theta_0|.

    Ordered by the importance at nine digits, then by term: equal terms don't
    change places with the order of a sum.
    """
    a, b = (F.max(F.when(F.col(label_col) == c, F.col("theta"))) for c in classes)
    return (theta.groupBy(F.col("term").alias("feature")).agg(F.abs(b - a).alias("importance"))
            .orderBy(F.desc(F.round("importance", 9)), "feature").limit(top)
            .select(F.lit(model_name).alias("model_name"), "feature", "importance"))
