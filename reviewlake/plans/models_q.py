"""Model queries: one hash split, one balanced training sample, five classifiers.

All rows are split first and only the training part is sampled, so scoring,
evaluation and export cover the whole test part; ``train_lr_weighted`` and
``train_lr_numeric`` are fitted on the whole training part. The comparison job is a set of
committed steps in the shared folder, keyed by a fingerprint of the input
files: it runs once, in whatever session, and goes on where it stopped.

What each oracle proves:

* Naive Bayes is refitted in SQL from the texts (vocabulary, idf, theta,
  priors), and every test row's prediction and probability compared.
* Logistic regression is proved by its gradient, an aggregate over the training
  rows that no fit takes part in, with the per-slot sums by label refitted in
  SQL (the hash function included).
* The decision tree is grown again in SQL, level by level (``tree_sql``); forest
  and boosted trees are walked over their written node table.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from reviewlake.operators import bayes as B
from reviewlake.operators import clean as C
from reviewlake.operators import evaluate as V
from reviewlake.operators import features as X
from reviewlake.operators import gradient as G
from reviewlake.operators import models as M
from reviewlake.operators import reports as R
from reviewlake.operators import sampling as S
from reviewlake.operators import trees as T
from reviewlake.operators.features import label_index
from reviewlake.plans.features_q import _SPLIT, _STOP, slots_sql
from reviewlake.plans.registry import register, with_views
from reviewlake.plans.tree_sql import tree_ctes
from reviewlake.session import ensure_checkpoint_dir, scratch_dir
from reviewlake.sinks.manifest import committed, fingerprint
from reviewlake.sinks.models import save_model
from reviewlake.sinks.tables import export_predictions
from reviewlake.sources.models import load_model
from reviewlake.sources.tables import reviews

# The comparison job's per-class sample size.
SAMPLE_PER_CLASS = 25000
# Part of the comparison's key: raise it when the job's code changes what it makes.
JOB_VERSION = 4
NB = M.MODEL_NAMES["nb"]


def split(spark, sf):
    """(train, test): all rows split 80/20 by md5(event_id); the training part is
    then sampled per class, the test part is whole."""
    s = S.hash_split(C.model_frame(reviews(spark, sf)), "event_id", 0.8)
    return S.balanced_sample(S.train_part(s), SAMPLE_PER_CLASS), S.test_part(s)


def comparison(spark, sf) -> M.Comparison:
    """The comparison job's committed result for these input files; run where it is missing."""
    key = fingerprint(spark, [f"{sf.rstrip('/')}/{t}.parquet" for t in ("documents", "labels")],
                      version=JOB_VERSION, sample=SAMPLE_PER_CLASS)
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/reviewlake-compare-{key}"
    if committed(spark, out, key) is None:
        train, test = split(spark, sf)
        M.compare_models(train, test, out, key=key)
    return M.Comparison(spark, out)


_FRAME = """(SELECT event_id, review_text, sentiment, CASE WHEN sentiment = 'positive' THEN 1.0 ELSE 0.0 END AS label
FROM reviews WHERE review_text IS NOT NULL AND sentiment IN ('negative', 'positive'))"""
_TEST = "md5(CAST(event_id AS VARCHAR)) >= 'cccccccc'"

# MLlib's own tokens: lower case, split at single white space, inner empty tokens kept, those at the end dropped
_WS = "[ \\t\\n\\v\\f\\r]"
_TOKENS = f"""CASE WHEN review_text <> '' AND regexp_replace(review_text, '{_WS}+$', '') = '' THEN []
  ELSE list_filter(string_split_regex(regexp_replace(lower(review_text), '{_WS}+$', ''), {_SPLIT}),
                   lambda x: NOT list_contains({_STOP}, x)) END"""

# training sample and test part, tokens, vocabulary, idf
_TEXTS = f"""
used AS MATERIALIZED (SELECT event_id, review_text, sentiment, label, is_test, w FROM (
  SELECT *, {_TEST} AS is_test, 1.0 AS w, row_number() OVER (
    PARTITION BY sentiment, {_TEST} ORDER BY md5(CAST(event_id AS VARCHAR)), event_id) AS rn FROM {_FRAME} f) x
  WHERE is_test OR rn <= {SAMPLE_PER_CLASS}),
tok AS (SELECT event_id, is_test, label, w, unnest({_TOKENS}) AS term FROM used),
tf AS MATERIALIZED (SELECT event_id, is_test, label, w, term, count(*) AS tf FROM tok GROUP BY ALL),
m AS (SELECT count(*)::DOUBLE AS m, count(*) FILTER (label = 0) AS n0, count(*) FILTER (label = 1) AS n1
      FROM used WHERE NOT is_test),
vocab AS MATERIALIZED (
  SELECT term, n, df, row_number() OVER (ORDER BY n DESC, term) - 1 AS f FROM (
    SELECT term, sum(tf) AS n, count(*) AS df FROM tf WHERE NOT is_test GROUP BY term HAVING count(*) >= {M.MIN_DF}
    ORDER BY n DESC, term LIMIT {M.VOCAB_SIZE}) v),
wt AS MATERIALIZED (SELECT event_id, is_test, label, f, term, tf * ln((m.m + 1.0) / (df + 1.0)) AS weight
                    FROM tf JOIN vocab USING (term), m)"""

_NB = f"""{_TEXTS},
cls AS (SELECT v.term, coalesce(sum(x.weight) FILTER (x.label = 0), 0.0) AS w0,
               coalesce(sum(x.weight) FILTER (x.label = 1), 0.0) AS w1
        FROM vocab v LEFT JOIN (SELECT * FROM wt WHERE NOT is_test) x USING (term) GROUP BY v.term),
theta AS (SELECT term, ln((w0 + 1.0) / (sum(w0) OVER () + count(*) OVER ())) AS t0,
                 ln((w1 + 1.0) / (sum(w1) OVER () + count(*) OVER ())) AS t1 FROM cls),
raw AS (SELECT u.event_id, u.label, u.review_text, u.sentiment, ln(n0 + 1.0) - ln(m + 2.0) + coalesce(s0, 0.0) AS r0,
               ln(n1 + 1.0) - ln(m + 2.0) + coalesce(s1, 0.0) AS r1
        FROM used u LEFT JOIN (SELECT event_id, sum(weight * t0) AS s0, sum(weight * t1) AS s1
                               FROM wt JOIN theta USING (term) WHERE is_test GROUP BY event_id) s USING (event_id), m
        WHERE u.is_test),
nb AS MATERIALIZED (SELECT *, CASE WHEN r1 > r0 THEN 1.0 ELSE 0.0 END AS prediction,
                           1 / (1 + exp(least(r0 - r1, 700.0))) AS p1 FROM raw)"""


def with_ctes(ctes: str, body: str) -> str:
    """``body`` with the review view and further CTEs before it."""
    return with_views("", "reviews").rstrip() + "," + ctes + "\n" + body


_NB_SCORED = with_ctes(_NB, "SELECT event_id, label, prediction, p1 AS probability FROM nb")


def _scored(pred):
    return pred.select("event_id", "label", "prediction", F.col("score").alias("probability"))


@register("train_nb", _NB_SCORED)
def q_train_nb(spark, sf):
    """Naive Bayes fitted on the training sample: every test row's prediction and probability."""
    train, test = split(spark, sf)
    return _scored(M.score(M.train_nb(train), test))


@register("nb_posterior", _NB_SCORED)
def q_nb_posterior(spark, sf):
    """The same model as relations: vocabulary, theta and priors joined to the test part's terms."""
    train, test = split(spark, sf)
    label = F.when(F.col("label_text") == "positive", 1).otherwise(0)
    train, test = train.withColumn("label", label), test.withColumn("label", label.cast("double"))
    tf = X.doc_terms(train, keep=("label",), parity=True)
    vocab = X.vocabulary(tf, M.VOCAB_SIZE, M.MIN_DF)
    theta = X.nb_theta(X.tfidf(tf, vocab, train, keep=("label",)), vocab)
    weights = X.tfidf(X.doc_terms(test, parity=True), vocab, train)
    post = B.nb_posterior(weights, test, theta, B.nb_prior(train))
    return test.select("event_id", "label").join(post, "event_id").select("event_id", "label", "prediction", "probability")


@register("score", _NB_SCORED)
def q_score(spark, sf):
    """Save the NB pipeline, load it back, score the test split with it."""
    path = save_model(comparison(spark, sf).model("nb"), f"{scratch_dir(spark, 'model')}/nb")
    return _scored(M.score(load_model(path), split(spark, sf)[1]))


@register("text_pipeline", _NB_SCORED)
def q_text_pipeline(spark, sf):
    """The whole six-stage Pipeline fitted in one call (NB), scored on the test split."""
    train, test = split(spark, sf)
    from pyspark.ml.classification import NaiveBayes
    model = X.text_pipeline(NaiveBayes(**M.NB_PARAMS)).fit(M.training_rows(train))
    return _scored(M.score(model, test))


@register("save_model", _NB_SCORED)
def q_save_model(spark, sf):
    """The comparison's saved Naive Bayes pipeline, read from its folder, scores every test row."""
    return _scored(M.score(load_model(comparison(spark, sf).model_path("nb")), split(spark, sf)[1]))


@register("load_model", _NB_SCORED)
def q_load_model(spark, sf):
    """A pipeline loaded, saved elsewhere, loaded again and applied to the test split."""
    again = save_model(load_model(comparison(spark, sf).model_path("nb")), f"{scratch_dir(spark, 'model')}/again")
    return _scored(M.score(load_model(again), split(spark, sf)[1]))


@register("index_to_label", with_ctes(_NB, """
SELECT event_id, sentiment AS label_text, CASE WHEN prediction = 1 THEN 'positive' ELSE 'negative' END AS prediction_text
FROM nb"""))
def q_index_to_label(spark, sf):
    """The Naive Bayes predictions as label texts."""
    return comparison(spark, sf).predictions("nb").select("event_id", "label_text", "prediction_text")


@register("probability_columns", with_ctes(_NB, """
SELECT event_id, CAST(1 - p1 AS FLOAT) AS probability_negative, CAST(p1 AS FLOAT) AS probability_positive FROM nb"""))
def q_probability_columns(spark, sf):
    return C.probability_columns(comparison(spark, sf).predictions("nb")).select(
        "event_id", "probability_negative", "probability_positive")


@register("export_predictions", with_ctes(_NB, """
SELECT event_id, review_text, sentiment AS label_text,
       CASE WHEN prediction = 1 THEN 'positive' ELSE 'negative' END AS prediction_text,
       CAST(1 - p1 AS FLOAT) AS probability_negative, CAST(p1 AS FLOAT) AS probability_positive FROM nb"""))
def q_export_predictions(spark, sf):
    """Naive Bayes' predictions of every test row written distributed, then read back."""
    path = f"{scratch_dir(spark, 'export')}/predictions"
    export_predictions(comparison(spark, sf).predictions("nb"), path)
    return spark.read.parquet(path)


@register("export_best_predictions", with_views(f"""
SELECT event_id, review_text, sentiment AS label_text, TRUE AS sums_to_one FROM {_FRAME} f WHERE {_TEST}""", "reviews"))
def q_export_best_predictions(spark, sf):
    """The same export for the model of the best F1, whichever it is: which rows, and sums of probabilities."""
    done = comparison(spark, sf)
    best = R.rank_models(done.metrics(), "f1_score").first()["model_name"]
    kind = next(k for k, n in M.MODEL_NAMES.items() if n == best)
    path = f"{scratch_dir(spark, 'export')}/predictions"
    export_predictions(done.predictions(kind), path)
    total = F.col("probability_negative") + F.col("probability_positive")
    return spark.read.parquet(path).select(
        "event_id", "review_text", "label_text", (F.abs(total - 1) < 1e-6).alias("sums_to_one"))


# ---------------------------------------------------------------- logistic regression

# What the gradient may be at most in any slot, in scaled features: after the reference's 20
# iterations, and after a fit that has converged (measured: below 0.006 and 1e-7, sf0.001 to sf0.1).
LR_TOLERANCE, CONVERGED_TOLERANCE = 0.01, 1e-6


def _lr_sql(used: str) -> str:
    """Sums of hashed tf-idf by slot and label over the training rows, the intercept's as slot -1."""
    return with_ctes(f"""{used},
terms AS (SELECT DISTINCT term FROM tf),
{slots_sql("terms", "term", M.HASHING_FEATURES)},
cell AS MATERIALIZED (SELECT event_id, label, w, slot, sum(tf) AS tf FROM tf JOIN slots USING (term) WHERE NOT is_test GROUP BY ALL),
df AS (SELECT slot, count(*) AS df FROM cell GROUP BY slot),
x AS (SELECT cell.slot, label, w * tf * ln((m.m + 1.0) / (df + 1.0)) AS weight FROM cell JOIN df USING (slot), m)""", """
SELECT slot::INT AS index, coalesce(sum(weight) FILTER (label = 0), 0.0) AS weight_0,
       coalesce(sum(weight) FILTER (label = 1), 0.0) AS weight_1, TRUE AS at_minimum FROM x GROUP BY slot
UNION ALL SELECT -1, sum(w) FILTER (label = 0), sum(w) FILTER (label = 1), TRUE FROM used WHERE NOT is_test""")


def _at_minimum(spark, model, train, weight_col=None, tolerance=LR_TOLERANCE):
    """Slot sums by label and whether the loss's gradient vanishes at the model's coefficients."""
    clf = model.stages[-1]
    scored = model.transform(train).withColumn("probability", vector_to_array("probability")[1])
    coefficients = spark.createDataFrame(
        [(i, float(v)) for i, v in enumerate(clf.coefficients.toArray()) if v], "index int, value double")
    g = G.logistic_gradient(scored, coefficients, clf.getRegParam(), weight_col=weight_col)
    return g.select("index", "weight_0", "weight_1", (F.abs("gradient") < tolerance).alias("at_minimum"))


@register("train_lr", _lr_sql(_TEXTS))
def q_train_lr(spark, sf):
    """Logistic regression with the reference's 20 iterations: the loss's gradient in every slot."""
    train = M.training_rows(split(spark, sf)[0])
    return _at_minimum(spark, M.train_lr(train), train)


@register("lr_minimum", _lr_sql(_TEXTS))
def q_lr_minimum(spark, sf):
    """The same regression fitted until it converges: its gradient vanishes, so no other coefficients do better."""
    train = M.training_rows(split(spark, sf)[0])
    model = M.fit_classifier(M.fit_features(train, hashing=True), train, "lr", **M.CONVERGED)
    return _at_minimum(spark, model, train, tolerance=CONVERGED_TOLERANCE)


_WEIGHTED = _TEXTS.replace(f"WHERE is_test OR rn <= {SAMPLE_PER_CLASS}", "").replace(
    "1.0 AS w", f"(count(*) OVER ()) / (2.0 * count(*) OVER (PARTITION BY sentiment)) AS w").replace(
    f"FROM {_FRAME} f) x", f"FROM {_FRAME} f WHERE NOT ({_TEST})) x")


@register("train_lr_weighted", _lr_sql(_WEIGHTED))
def q_train_lr_weighted(spark, sf):
    """E2: logistic regression on the whole (unbalanced) training split, with
    per-class loss weights instead of undersampling; proved like ``train_lr``."""
    s = S.hash_split(C.model_frame(reviews(spark, sf)), "event_id", 0.8)
    train = X.with_class_weights(S.train_part(s))
    fm = M.fit_features(train, hashing=True)
    return _at_minimum(spark, M.fit_classifier(fm, train, "lr", weight_col="weight"), train, "weight")


_RANGE_SQL = with_views(f"""
SELECT event_id, label, TRUE AS score_in_range, TRUE AS prediction_agrees FROM {_FRAME} f WHERE {_TEST}""", "reviews")


@register("lr_scores", _RANGE_SQL)
def q_lr_scores(spark, sf):
    """Logistic regression's scores of every test row: in range, and agreeing with the predictions."""
    agrees = (F.col("prediction") == 1.0) == (F.col("score") > 0.5)
    return comparison(spark, sf).predictions("lr").select(
        "event_id", "label", F.col("score").between(0.0, 1.0).alias("score_in_range"), agrees.alias("prediction_agrees"))


# --------------------------------------------------------------- numeric features (E1)

def _review_parts(spark, sf):
    """(train, test): all rows split as in ``split``, all review columns kept; both parts are whole."""
    r = reviews(spark, sf, prefilter=True).where(F.col("review_text").isNotNull() & F.col("sentiment").isin("negative", "positive"))
    s = S.hash_split(r.withColumn("label_text", F.col("sentiment")), "event_id", 0.8)
    return S.train_part(s), S.test_part(s)


def _review_split(spark, sf):
    """``split`` with all review columns kept."""
    train, test = _review_parts(spark, sf)
    return S.balanced_sample(train, SAMPLE_PER_CLASS), test


# both parts with their numbers: app statistics, fill values and deviations from the training sample
_NUMBERS = f"""{_TEXTS},
app AS (SELECT app_id, count(*) AS c, avg(u.label) AS r FROM reviews JOIN used u USING (event_id) WHERE NOT is_test GROUP BY app_id),
num AS (SELECT u.event_id, u.is_test, u.label, length(u.review_text)::DOUBLE AS n0,
               len(list_filter(string_split_regex(lower(u.review_text), {_SPLIT}), lambda x: x <> ''))::DOUBLE AS n1,
               r.review_votes::DOUBLE AS n2, app.c::DOUBLE AS n3, app.r AS n4
        FROM used u JOIN reviews r USING (event_id) LEFT JOIN app USING (app_id)),
st AS (SELECT {", ".join(f"avg(n{i}) AS a{i}, stddev_samp(n{i}) AS d{i}" for i in range(5))} FROM num WHERE NOT is_test),
scaled AS MATERIALIZED (SELECT event_id, is_test, label,
  {", ".join(f"CASE WHEN d{i} = 0 THEN 0.0 ELSE coalesce(n{i}, a{i}) / d{i} END AS s{i}" for i in range(5))} FROM num, st)"""


# the same with the training part whole
_WHOLE_NUMBERS = _NUMBERS.replace(f"\n  WHERE is_test OR rn <= {SAMPLE_PER_CLASS}", "")


@register("train_lr_numeric", with_ctes(_WHOLE_NUMBERS, """
SELECT f::INT AS index, coalesce(sum(weight) FILTER (label = 0), 0.0) AS weight_0,
       coalesce(sum(weight) FILTER (label = 1), 0.0) AS weight_1, TRUE AS at_minimum FROM wt WHERE NOT is_test GROUP BY f
UNION ALL
SELECT ((SELECT count(*) FROM vocab) + i)::INT, coalesce(sum(s) FILTER (label = 0), 0.0), coalesce(sum(s) FILTER (label = 1), 0.0), TRUE
FROM (SELECT label, unnest([s0, s1, s2, s3, s4]) AS s, unnest(range(5)) AS i FROM scaled WHERE NOT is_test) x WHERE s <> 0 GROUP BY i
UNION ALL SELECT -1, count(*) FILTER (label = 0), count(*) FILTER (label = 1), TRUE FROM used WHERE NOT is_test"""))
def q_train_lr_numeric(spark, sf):
    """E1 as model input: text and numbers of the whole training part in one vector, proved by the loss's gradient."""
    train = _review_parts(spark, sf)[0]
    rows = M.training_rows(X.with_numeric(train, train), whole=True)
    return _at_minimum(spark, M.train_lr_numeric(train, rows), rows, tolerance=CONVERGED_TOLERANCE)


@register("lr_numeric_scores", with_ctes(_NUMBERS, """
SELECT event_id, label, s0 AS length, s1 AS words, s2 AS votes, s3 AS app_reviews, s4 AS app_positive, TRUE AS score_in_range
FROM scaled WHERE is_test"""))
def q_lr_numeric_scores(spark, sf):
    """Every test row's numbers as the classifier sees them, and a score in range."""
    train, test = _review_split(spark, sf)
    train = M.training_rows(train)
    scored = M.score(M.train_lr_numeric(train), X.with_numeric(test, train))
    number = vector_to_array("scaled_numbers")
    names = ["length", "words", "votes", "app_reviews", "app_positive"]
    return scored.select("event_id", "label", *[number[i].alias(n) for i, n in enumerate(names)],
                         F.col("score").between(0.0, 1.0).alias("score_in_range"))


# ------------------------------------------------------------------------------- trees

_WALKED_SQL = with_views(f"""
SELECT event_id, label, TRUE AS same_prediction, TRUE AS same_probability FROM {_FRAME} f WHERE {_TEST}""", "reviews")


def _walked(spark, sf, kind):
    """MLlib's scores of every test row against a walk over the saved node table."""
    done = comparison(spark, sf)
    nodes = T.node_table(spark, done.model_path(kind))
    test = split(spark, sf)[1]
    for stage in done.model(kind).stages[:-1]:
        test = stage.transform(test)
    mine = T.walk_scores(nodes, test, boosted=kind == "gbt")
    theirs = done.predictions(kind).select("event_id", F.col("prediction").alias("p"), F.col("score").alias("s"))
    return mine.join(theirs, "event_id").select(
        "event_id", "label", (F.col("prediction") == F.col("p")).alias("same_prediction"),
        (F.abs(F.col("probability") - F.col("s")) < 1e-9).alias("same_probability"))


@register("train_rf", _WALKED_SQL)
def q_train_rf(spark, sf):
    """The forest fitted on the training sample: a walk over its written nodes gives MLlib's scores."""
    return _walked(spark, sf, "rf")


@register("train_gbt", _WALKED_SQL)
def q_train_gbt(spark, sf):
    """The boosted trees: a walk over their written nodes gives MLlib's scores."""
    return _walked(spark, sf, "gbt")


_TREE = f"{_TEXTS},\n{tree_ctes(M.DT_PARAMS['maxDepth'])}"


@register("train_dt", with_ctes(_TREE, "SELECT event_id, label, prediction, probability FROM tree_scored"))
def q_train_dt(spark, sf):
    """The decision tree fitted on the training sample, scoring every test row; SQL grows the same tree."""
    train, test = split(spark, sf)
    return _scored(M.score(M.train_dt(train), test))


@register("walk_dt", with_ctes(_TREE, "SELECT event_id, label, prediction, probability FROM tree_scored"))
def q_walk_dt(spark, sf):
    """The saved tree's node table walked over every test row."""
    done = comparison(spark, sf)
    test = split(spark, sf)[1]
    for stage in done.model("dt").stages[:-1]:
        test = stage.transform(test)
    return T.walk_scores(T.node_table(spark, done.model_path("dt")), test)


# ---------------------------------------------------------------------------- the rest

@register("label_index", with_views("""
SELECT event_id, CASE WHEN sentiment = 'negative' THEN 0.0 ELSE 1.0 END AS label FROM reviews
WHERE review_text IS NOT NULL AND sentiment IN ('negative', 'positive')""", "reviews"))
def q_label_index(spark, sf):
    mf = C.model_frame(reviews(spark, sf))
    return label_index().fit(mf).transform(mf).select("event_id", "label")


@register("compare_models")
def q_compare_models(spark, sf):
    """One row per model: accuracy, weighted F1/precision/recall, AUC (from probability)."""
    return comparison(spark, sf).metrics()


_NB_METRICS = """
pk AS (SELECT k, sum(a) AS actual, sum(p) AS predicted, sum(h) AS hit FROM (
  SELECT label AS k, 1 AS a, 0 AS p, CASE WHEN label = prediction THEN 1 ELSE 0 END AS h FROM nb
  UNION ALL SELECT prediction, 0, 1, 0 FROM nb) s GROUP BY k),
pr AS (SELECT actual, hit, CASE WHEN predicted = 0 THEN 0 ELSE hit / predicted END AS prec,
              CASE WHEN actual = 0 THEN 0 ELSE hit / actual END AS rec FROM pk)"""


@register("run_metrics", with_ctes(_NB + "," + _NB_METRICS, f"""
SELECT '{NB}' AS run_name, metric, value FROM (
  SELECT sum(hit) / sum(actual) AS accuracy,
         sum(actual * CASE WHEN prec + rec = 0 THEN 0 ELSE 2 * prec * rec / (prec + rec) END) / sum(actual) AS f1_score,
         sum(actual * prec) / sum(actual) AS weighted_precision, sum(actual * rec) / sum(actual) AS weighted_recall FROM pr) x
UNPIVOT (value FOR metric IN (accuracy, f1_score, weighted_precision, weighted_recall))"""))
def q_run_metrics(spark, sf):
    """The metrics in Naive Bayes' run record, as rows (its AUC hangs on ties of saturated probabilities: not compared)."""
    runs = comparison(spark, sf).runs().where(F.col("run_name") == NB)
    return runs.select("run_name", F.explode("metrics").alias("metric", "value")).where(F.col("metric") != "area_under_roc")


@register("track_run", """
SELECT run_name, TRUE AS has_params, 5 AS n_metrics, 4 AS n_artifacts, TRUE AS in_order
FROM (VALUES ('Logistic Regression'), ('Decision Tree Classifier'), ('Random Forest Classifier'),
             ('GBT Classifier'), ('Naive Bayes')) t(run_name)""")
def q_track_run(spark, sf):
    """The comparison's run records: fitted parameters, metrics, artifact paths and times."""
    has = F.array_contains(F.map_keys("params"), "CountVectorizerModel.vocabSize") | F.array_contains(
        F.map_keys("params"), "HashingTF.numFeatures")
    return comparison(spark, sf).runs().select(
        "run_name", has.alias("has_params"), F.size("metrics").alias("n_metrics"),
        F.size("artifacts").alias("n_artifacts"), (F.col("start_time") < F.col("end_time")).alias("in_order"))


@register("count_vectorize", with_ctes(_TEXTS, """
SELECT event_id, term, tf AS count FROM tf JOIN vocab USING (term) WHERE NOT is_test"""))
def q_count_vectorize(spark, sf):
    """What the fitted CountVectorizer counts in every training document."""
    return M.count_vectorize(comparison(spark, sf).model("nb"), split(spark, sf)[0])


@register("get_vocabulary", with_ctes(_TEXTS, "SELECT f::INT AS index, term FROM vocab"))
def q_get_vocabulary(spark, sf):
    return M.get_vocabulary(spark, comparison(spark, sf).model("dt"))


# -------------------------------------------------------------------------- importance

_IMPORTANCE = f"""{_NB},
imp AS (SELECT '{NB}' AS model_name, term AS feature, abs(t1 - t0) AS importance FROM theta
        ORDER BY round(abs(t1 - t0), 9) DESC, term LIMIT 30)"""


def nb_importance(spark, sf):
    """The 30 strongest terms of the saved Naive Bayes model."""
    return comparison(spark, sf).importance("nb")


@register("feature_importance", with_ctes(_IMPORTANCE, "SELECT * FROM imp"))
def q_feature_importance(spark, sf):
    return nb_importance(spark, sf)


@register("nb_importance", with_ctes(_IMPORTANCE, "SELECT * FROM imp"))
def q_nb_importance(spark, sf):
    """The same list from the relational theta."""
    train, _ = split(spark, sf)
    train = train.withColumn("label", F.when(F.col("label_text") == "positive", 1).otherwise(0))
    tf = X.doc_terms(train, keep=("label",), parity=True)
    vocab = X.vocabulary(tf, M.VOCAB_SIZE, M.MIN_DF)
    return B.nb_importance(X.nb_theta(X.tfidf(tf, vocab, train, keep=("label",)), vocab), NB)


@register("top_features", with_ctes(_IMPORTANCE, "SELECT * FROM imp"))
def q_top_features(spark, sf):
    """The 30 strongest features of a loaded model."""
    return M.feature_importance(spark, comparison(spark, sf).model("nb"), NB, 30)


@register("top_features_n", with_ctes(_IMPORTANCE, """
SELECT *, abs(importance) AS abs_importance FROM imp ORDER BY round(importance, 9) DESC, feature LIMIT 20"""))
def q_top_features_n(spark, sf):
    return R.top_features_n(nb_importance(spark, sf), 20)


# log odds of a term under the two classes, the signed form of Naive Bayes' weights
_SIGNED = f"""{_NB},
odds AS (SELECT '{NB}' AS model_name, term AS feature, t1 - t0 AS importance FROM theta)"""


def nb_odds(spark, sf):
    """(model_name, feature, importance): theta_1 - theta_0 of every term, sign kept."""
    model = comparison(spark, sf).model("nb")
    theta = model.stages[-1].theta.toArray()
    odds = spark.createDataFrame([(i, float(v)) for i, v in enumerate(theta[1] - theta[0])], "index int, importance double")
    return odds.join(M.get_vocabulary(spark, model), "index").select(
        F.lit(NB).alias("model_name"), F.col("term").alias("feature"), "importance")


@register("signed_features", with_ctes(_SIGNED, """
(SELECT *, 'positive' AS direction FROM odds WHERE importance > 0 ORDER BY round(importance, 9) DESC, feature LIMIT 5)
UNION ALL
(SELECT *, 'negative' AS direction FROM odds WHERE importance < 0 ORDER BY round(importance, 9), feature LIMIT 5)"""))
def q_signed_features(spark, sf):
    return R.signed_features(nb_odds(spark, sf), 5)


@register("top_features_per_model", with_ctes(_SIGNED, f"""
SELECT model_name, string_agg(feature, ', ' ORDER BY round(abs(importance), 9) DESC, feature) AS top_features FROM (
  SELECT * FROM odds ORDER BY round(abs(importance), 9) DESC, feature LIMIT 5) t GROUP BY model_name"""))
def q_top_features_per_model(spark, sf):
    return R.top_features_per_model(nb_odds(spark, sf), 5)


@register("abs_importance", with_ctes(_SIGNED, """
SELECT *, abs(importance) AS abs_importance, CASE WHEN importance >= 0 THEN 'positive' ELSE 'negative' END AS direction FROM odds"""))
def q_abs_importance(spark, sf):
    return C.abs_importance(nb_odds(spark, sf))


def importance(spark, sf):
    """All five models' strongest features, as the comparison job wrote them."""
    done = comparison(spark, sf)
    return R.concat_results([done.importance(k) for k in M.MODEL_NAMES])


@register("feature_importance_all")
def q_feature_importance_all(spark, sf):
    """Five models' lists; trees' vectors are compared with MLlib's in the tests."""
    return importance(spark, sf)


@register("top_features_per_model_all")
def q_top_features_per_model_all(spark, sf):
    return R.top_features_per_model(importance(spark, sf), 5)


@register("auc_raw_vs_probability")
def q_auc_raw_vs_probability(spark, sf):
    """Per model: AUC from the positive-class probability (ours) and from the
    raw prediction vector (the reference's evaluator input, not a probability
    for Naive Bayes or trees): one pass over all models' stacked scores."""
    done = comparison(spark, sf)
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("value"))
                      for k, c in (("probability", "score"), ("raw", "raw_score"))])
    long = R.concat_results([done.predictions(k).select(F.lit(n).alias("model_name"), "label", F.inline(kinds))
                             for k, n in M.MODEL_NAMES.items()])
    areas = V.auc(long, "label", "value", by=("model_name", "kind"))
    pick = lambda k: F.max(F.when(F.col("kind") == k, F.col("area_under_roc")))
    return areas.groupBy("model_name").agg(pick("probability").alias("area_under_roc"), pick("raw").alias("area_under_roc_raw"))


@register("hashed_feature_terms")
def q_hashed_feature_terms(spark, sf):
    """LR's top hashed features named by the training-corpus terms in each slot."""
    tf = X.doc_terms(M.training_rows(split(spark, sf)[0]))
    return X.resolve_hashed_features(comparison(spark, sf).importance("lr"), tf, M.HASHING_FEATURES)
