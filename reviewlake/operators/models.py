"""Text classifiers on MLlib (section 2.10).

Fits are MLlib's own distributed aggregations over the training rows they are
given, a balanced sample or the whole training part; scoring covers every row
it is given. The training rows are computed once (``training_rows``): a fit's
passes read them back, in as many tasks as their number needs, however many the
input had. The feature stages are fitted once per feature kind and shared by
every classifier using them; predictions are written once and every report is
derived from that one table.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       LogisticRegressionModel, NaiveBayes, RandomForestClassifier)
from pyspark.ml.feature import IndexToString
from pyspark.ml.functions import vector_to_array
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.operators import evaluate as V
from reviewlake.operators.features import doc_terms, feature_stages, mixed_stages, vocabulary, with_numeric
from reviewlake.session import ensure_checkpoint_dir

# Classifier settings of the reference jobs.
SEED = 42
LR_PARAMS = {"maxIter": 20, "regParam": 0.01}
DT_PARAMS = {"maxDepth": 5, "seed": SEED}
RF_PARAMS = {"numTrees": 20, "maxDepth": 5, "seed": SEED}
GBT_PARAMS = {"maxIter": 20, "maxDepth": 5, "seed": SEED}
NB_PARAMS = {"smoothing": 1.0, "modelType": "multinomial"}
HASHING_FEATURES = 20000
VOCAB_SIZE = 5000
MIN_DF = 5
# Training rows a task of a fit takes, and the number of tasks that is no matter however few the rows.
ROWS_PER_TASK = 2048
FEW_TASKS = 8
# Rows a task takes at most where a whole training part stays as it lies, and of vectors in a fit of many passes.
MOST_ROWS_PER_TASK = 16384

METRICS = ["accuracy", "f1_score", "weighted_precision", "weighted_recall", "area_under_roc"]

MODEL_NAMES = {
    "lr": "Logistic Regression", "dt": "Decision Tree Classifier",
    "rf": "Random Forest Classifier", "gbt": "GBT Classifier", "nb": "Naive Bayes",
}


def classifier(kind: str, weight_col: str | None = None, **more):
    """A fresh estimator of one kind, reading the ``features``/``label`` columns.

    ``more`` replaces single settings of the fixed ones.
    ``weight_col`` (e.g. from ``features.with_class_weights``) weights the
    loss per row instead of undersampling the majority class.
    """
    cls, params = {
        "lr": (LogisticRegression, LR_PARAMS), "dt": (DecisionTreeClassifier, DT_PARAMS),
        "rf": (RandomForestClassifier, RF_PARAMS), "gbt": (GBTClassifier, GBT_PARAMS),
        "nb": (NaiveBayes, NB_PARAMS),
    }[kind]
    extra = {"weightCol": weight_col} if weight_col else {}
    return cls(featuresCol="features", labelCol="label", **{**params, **extra, **more})


def training_rows(train: DataFrame, whole: bool = False) -> DataFrame:
    """``train`` computed once, in a number of partitions that goes by its own rows.

    A fit passes over its rows many times (a boosted forest a hundred times).
    Each pass over a sample that is only planned draws it anew from the whole
    input, with a task for every split of the input, and sends that many
    partial sums. The rows are kept in the shared checkpoint folder; too many
    or too few partitions are dealt again by the first column, in an order that
    does not hang on the input's layout.

    ``whole=True`` is for a training part that is the input's size, not a
    sample of it: its partitions stay as they lie (too many are read several to
    a task), so that the texts are neither shuffled nor written again, unless
    one would have over ``MOST_ROWS_PER_TASK`` rows on average.
    """
    ensure_checkpoint_dir(train.sparkSession)
    kept = train.checkpoint(eager=True)
    rows, parts = kept.count(), kept.rdd.getNumPartitions()
    n = max(1, math.ceil(rows / ROWS_PER_TASK))
    most = max(n, FEW_TASKS)
    if whole:
        n = min(n, max(FEW_TASKS, math.ceil(rows / MOST_ROWS_PER_TASK)))
        if parts > most:
            return kept.coalesce(most)
    if n <= parts <= most:
        return kept
    key, hashed = train.columns[0], [c for c, t in train.dtypes if "map<" not in t]
    return kept.repartition(n, key).sortWithinPartitions(key, F.xxhash64(*hashed)).checkpoint(eager=True)


def fit_features(train: DataFrame, hashing: bool = False, vocab_size: int = VOCAB_SIZE,
                 min_df: int = MIN_DF, numeric: bool = False) -> PipelineModel:
    """Fit label index, tokenizer, stop words, counts (vocabulary or HashingTF), IDF.

    The vocabulary is ``features.vocabulary`` over MLlib's own tokens: what
    ``CountVectorizer`` would fit, but with equal counts ordered by term, so
    that feature indices don't change with the layout of the data. Its terms
    (at most ``vocab_size``) pass through the driver. ``numeric=True`` appends
    the scaled numeric columns (E1) of ``features.with_numeric``.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import CountVectorizerModel
    stages = feature_stages(vocab_size=vocab_size, min_df=min_df,
                            hashing_features=HASHING_FEATURES if hashing else None)
    if not hashing:
        found = vocabulary(doc_terms(train, train.columns[0], parity=True), vocab_size, min_df)
        terms = [r["term"] for r in found.orderBy("rank").collect()]
        stages[3] = CountVectorizerModel.from_vocabulary(terms, inputCol="filtered_words", outputCol="tf_features")
    if numeric:
        stages = mixed_stages(stages)
    return Pipeline(stages=stages).fit(train)


def fit_classifier(features: PipelineModel, train: DataFrame, kind: str,
                   train_features: DataFrame | None = None,
                   weight_col: str | None = None, **more) -> PipelineModel:
    """Fit one classifier on shared features; return the full pipeline model."""
    feats = train_features if train_features is not None else features.transform(train)
    clf = classifier(kind, weight_col, **more).fit(feats)
    return PipelineModel(stages=list(features.stages) + [clf])


def _train(train: DataFrame, kind: str, hashing: bool) -> PipelineModel:
    train = training_rows(train)
    return fit_classifier(fit_features(train, hashing=hashing), train, kind)


def train_lr(train: DataFrame) -> PipelineModel:
    """Logistic regression on hashed tf-idf (20,000 slots), maxIter 20, regParam 0.01."""
    return _train(train, "lr", hashing=True)


def train_dt(train: DataFrame) -> PipelineModel:
    """Decision tree, depth 5, seed 42, on vocabulary tf-idf."""
    return _train(train, "dt", hashing=False)


def train_rf(train: DataFrame) -> PipelineModel:
    """Random forest, 20 trees of depth 5, seed 42."""
    return _train(train, "rf", hashing=False)


def train_gbt(train: DataFrame) -> PipelineModel:
    """Gradient-boosted trees, 20 rounds of depth 5, seed 42."""
    return _train(train, "gbt", hashing=False)


def train_nb(train: DataFrame) -> PipelineModel:
    """Multinomial Naive Bayes, smoothing 1.0."""
    return _train(train, "nb", hashing=False)


# Iterations until a fit has converged: L-BFGS stops earlier at this tolerance.
CONVERGED = {"maxIter": 1000, "tol": 1e-10}


def train_lr_numeric(train: DataFrame, rows: DataFrame | None = None) -> PipelineModel:
    """Logistic regression on vocabulary tf-idf and the five scaled numeric features (E1), fitted until it converges.

    ``train`` has the review columns; score rows with ``with_numeric(rows,
    train)`` so that app statistics come from the training rows alone. A caller
    that has ``training_rows(with_numeric(train, train))`` already gives it as
    ``rows``. The rows' vectors are made once, in the rows' tasks; the fit's
    passes, about a hundred short ones, take them in fewer.
    """
    if rows is None:
        rows = training_rows(with_numeric(train, train))
    fm = fit_features(rows, numeric=True)
    made = fm.transform(rows).select("label", "features").persist(StorageLevel.MEMORY_AND_DISK)
    dealt = made.coalesce(max(FEW_TASKS, math.ceil(made.count() / MOST_ROWS_PER_TASK)))
    model = fit_classifier(fm, rows, "lr", dealt, **CONVERGED)
    model.stages[-1] = settle_intercept(model.stages[-1], made)
    made.unpersist()
    return model


def settle_intercept(clf: LogisticRegressionModel, feats: DataFrame) -> LogisticRegressionModel:
    """``clf`` with its intercept moved by one Newton step: one aggregate over ``feats``.

    MLlib fits centred features and stops at a small rest of the gradient. In a
    feature that isn't centred the intercept's rest counts times its mean over
    its deviation, and that is large where values hardly differ, as an app's
    share of positive reviews does. Near the minimum a step squares the rest.
    """
    if not math.isfinite(clf.intercept):        # one class only
        return clf
    p = vector_to_array("probability")[1]
    rest, curve = clf.transform(feats).agg(F.sum(p - F.col("label")), F.sum(p * (1 - p))).first()
    if not curve:
        return clf
    settled = LogisticRegressionModel(JavaWrapper._new_java_obj(
        "org.apache.spark.ml.classification.LogisticRegressionModel", clf.uid, clf.coefficients, clf.intercept - rest / curve))
    return clf._copyValues(settled)


def index_to_label(model: PipelineModel, pred: DataFrame, in_col: str = "prediction",
                   out_col: str = "prediction_text") -> DataFrame:
    """Predicted index -> label text with the fitted label indexer's labels."""
    return IndexToString(inputCol=in_col, outputCol=out_col,
                         labels=model.stages[0].labels).transform(pred)


def score(model: PipelineModel, df: DataFrame, score_col: str = "probability") -> DataFrame:
    """Apply a fitted pipeline: prediction, prediction_text and a scalar ``score``.

    ``score`` = positive-class probability (default) or the positive-class raw
    value (``score_col="rawPrediction"``, the reference's AUC input, which is
    not a probability for Naive Bayes or trees).
    """
    pred = index_to_label(model, model.transform(df))
    return pred.withColumn("score", vector_to_array(F.col(score_col))[1])


def count_vectorize(features: PipelineModel, df: DataFrame, doc_col: str = "event_id") -> DataFrame:
    """(doc, term, count): what the fitted vectorizer counts in each document of ``df``.

    The count vector's entries become rows inside the JVM (``unwrap_udt``);
    the vocabulary is bounded by its size parameter and broadcast.
    """
    counts = features.transform(df).select(doc_col, F.unwrap_udt("tf_features").alias("v"))
    cells = counts.select(doc_col, F.inline(F.arrays_zip(
        F.col("v.indices").alias("index"), F.col("v.values").alias("count"))))
    vocab = get_vocabulary(df.sparkSession, features)
    return cells.join(F.broadcast(vocab), "index").select(doc_col, "term", F.col("count").cast("long").alias("count"))


def get_vocabulary(spark: SparkSession, model: PipelineModel) -> DataFrame | None:
    """(index, term) of the first stage having a vocabulary, else None (model-sized)."""
    for st in model.stages:
        vocab = getattr(st, "vocabulary", None)
        if vocab:
            return spark.createDataFrame(list(enumerate(vocab)), "index INT, term STRING")
    return None


def _vector_frame(spark: SparkSession, values) -> DataFrame:
    """(index, value) from a model-sized weight vector."""
    return spark.createDataFrame([(int(i), float(v)) for i, v in enumerate(values)],
                                 "index INT, value DOUBLE")


def feature_importance(spark: SparkSession, model: PipelineModel, model_name: str,
                       top: int = 30) -> DataFrame:
    """(model_name, feature, importance): top ``top`` features by model family.

    Trees: importance desc; logistic regression: |coefficient| desc, sign
    kept; Naive Bayes: |theta_1 - theta_0|; ties (at nine digits) by feature
    name. Index -> term through the vocabulary (broadcast join,
    vocabulary-sized); ``feature_i`` / ``hash_feature_i`` when there is none; a
    ``not_available`` row otherwise.
    """
    clf = model.stages[-1]
    prefix = "feature_"
    if hasattr(clf, "featureImportances"):
        vals = clf.featureImportances.toArray()
    elif hasattr(clf, "coefficients"):
        vals = clf.coefficients.toArray()
        prefix = "hash_feature_"
    elif hasattr(clf, "theta") and clf.theta.numRows >= 2:
        th = clf.theta.toArray()
        vals = abs(th[1] - th[0])
    else:
        return spark.createDataFrame([(model_name, "not_available", 0.0)],
                                     "model_name STRING, feature STRING, importance DOUBLE")
    weights = _vector_frame(spark, vals)
    vocab = get_vocabulary(spark, model)
    if vocab is not None:
        weights = weights.join(F.broadcast(vocab), "index", "left")
    else:
        weights = weights.withColumn("term", F.lit(None).cast("string"))
    name = F.coalesce(F.col("term"), F.concat(F.lit(prefix), F.col("index").cast("string")))
    return (weights.select(F.lit(model_name).alias("model_name"), name.alias("feature"), F.col("value").alias("importance"))
            .orderBy(F.desc(F.round(F.abs("importance"), 9)), "feature").limit(top))


@dataclass
class Comparison:
    """A comparison job's results below its folder, read when asked for."""
    spark: SparkSession
    out: str

    def metrics(self) -> DataFrame:
        """One row per model: model_name and the five metrics."""
        return self.spark.read.parquet(f"{self.out}/comparison")

    def predictions(self, kind: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.out}/{kind}/predictions")

    def importance(self, kind: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.out}/{kind}/importance")

    def model_path(self, kind: str) -> str:
        return f"{self.out}/{kind}/model"

    def model(self, kind: str) -> PipelineModel:
        return PipelineModel.load(self.model_path(kind))

    def runs(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.out}/runs")


def compare_models(train: DataFrame, test: DataFrame, out: str,
                   kinds: tuple[str, ...] = ("lr", "dt", "rf", "gbt", "nb"),
                   score_col: str = "probability", parallel: bool = True, key: str | None = None) -> Comparison:
    """Fit every model on the same rows, score the same test rows, evaluate, keep all.

    Below the shared folder ``out`` each model leaves ``<kind>/predictions``
    (every test row), ``<kind>/confusion``, ``<kind>/importance`` and
    ``<kind>/model``; ``comparison`` has one row per model and ``runs`` its
    record. The training rows are drawn once and the test rows written once
    (``test``), narrow; feature stages are fitted once per feature kind, and so
    are the rows' vectors made, for all models using them. All models' written
    predictions are evaluated together, in one pass.

    Each model is a committed step (``sinks.manifest``). With ``key``, a
    fingerprint of the inputs, a rerun after a lost driver reads the models
    that were committed under that key and fits only the others; without it
    everything runs anew.

    ``parallel=True`` submits the independent fits from driver threads, so
    their (small, overhead-bound) jobs share the executors instead of
    queueing one model after another; results do not depend on it.
    """
    import datetime as dt
    from concurrent.futures import ThreadPoolExecutor

    from reviewlake.sinks.manifest import commit, committed, step
    from reviewlake.sinks.models import model_params, save_model, write_runs

    spark, out = train.sparkSession, out.rstrip("/")
    key = key or uuid.uuid4().hex
    done = Comparison(spark, out)

    def run(fn, items):
        items = list(items)
        if not parallel or len(items) < 2:
            return [fn(x) for x in items]
        with ThreadPoolExecutor(max_workers=len(items)) as pool:
            return list(pool.map(fn, items))

    missing = [k for k in kinds if committed(spark, f"{out}/{k}", key) is None]
    if missing:
        keep = [c for c in test.columns if c in ("event_id", "review_text", "label_text")]

        def tested() -> dict:
            test.select(*keep).write.mode("overwrite").parquet(f"{out}/test/rows")
            return {"columns": keep}

        sample, _ = run(lambda f: f(), [lambda: training_rows(train), lambda: step(spark, f"{out}/test", key, tested)])
        held_out = spark.read.parquet(f"{out}/test/rows")

    def featurise(hashing: bool):
        fm = fit_features(sample, hashing=hashing)
        # iterative fits read this many times; the training rows are bounded by the sample
        made = fm.transform(sample).select("label", "features").persist(StorageLevel.MEMORY_AND_DISK)
        scored = fm.transform(held_out).select(*keep, "label", "features")
        if sum((k == "lr") == hashing for k in missing) > 1:
            scored = scored.persist(StorageLevel.MEMORY_AND_DISK)     # filled by the first model that scores
        return hashing, (fm, made, scored)

    feats = dict(run(featurise, sorted({k == "lr" for k in missing})))

    def fit_and_score(kind: str) -> dict:
        def made() -> dict:
            start = dt.datetime.now(dt.timezone.utc)
            fm, tf, rows = feats[kind == "lr"]
            model = fit_classifier(fm, sample, kind, tf)
            base = f"{out}/{kind}"
            # the rows' vectors are there: label index and classifier are left
            scored = score(PipelineModel(stages=[model.stages[0], model.stages[-1]]), rows.drop("label"), score_col)
            raw = vector_to_array("rawPrediction")[1].alias("raw_score")
            cols = [*keep, "label", "prediction", "prediction_text", "probability", raw, "score"]
            (scored.select(*cols).withColumn("probability", vector_to_array("probability"))
             .write.mode("overwrite").parquet(f"{base}/predictions"))
            V.confusion_matrix(done.predictions(kind)).write.mode("overwrite").parquet(f"{base}/confusion")
            feature_importance(spark, model, MODEL_NAMES[kind]).write.mode("overwrite").parquet(f"{base}/importance")
            save_model(model, f"{base}/model")
            return {"params": model_params(model), "start": start.isoformat(),
                    "end": dt.datetime.now(dt.timezone.utc).isoformat()}
        return step(spark, f"{out}/{kind}", key, made)

    records = dict(zip(kinds, run(fit_and_score, kinds)))
    for _, tf, rows in feats.values():
        tf.unpersist()
        rows.unpersist()

    def compared() -> dict:
        stacked = reduce(DataFrame.unionByName, [
            done.predictions(k).select("label", "prediction", "score", F.lit(MODEL_NAMES[k]).alias("model_name")) for k in kinds])
        V.evaluate_groups(stacked).select("model_name", *METRICS).write.mode("overwrite").parquet(f"{out}/comparison")
        metrics = {r["model_name"]: r.asDict() for r in done.metrics().collect()}     # one row a model
        write_runs(spark, f"{out}/runs", [
            (MODEL_NAMES[k], records[k]["params"], {m: metrics[MODEL_NAMES[k]][m] for m in METRICS if metrics[MODEL_NAMES[k]][m] is not None},
             {a: f"{out}/{k}/{a}" for a in ("model", "predictions", "confusion", "importance")},
             dt.datetime.fromisoformat(records[k]["start"]), dt.datetime.fromisoformat(records[k]["end"])) for k in kinds])
        return {"models": list(kinds)}

    if committed(spark, out, key) != {"models": list(kinds)}:
        commit(spark, out, compared(), key)
    return done
