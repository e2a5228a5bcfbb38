"""Fitted models against what the library works out by itself: nodes, posteriors, gradients."""

import tempfile

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from reviewlake.operators import bayes as B
from reviewlake.operators import clean as C
from reviewlake.operators import features as X
from reviewlake.operators import gradient as G
from reviewlake.operators import models as M
from reviewlake.operators import sampling as S
from reviewlake.operators import trees as T
from reviewlake.sinks.models import save_model
from reviewlake.sources.tables import reviews
from tests.conftest import SF_MID


@pytest.fixture(scope="module")
def parts(spark):
    s = S.hash_split(C.model_frame(reviews(spark, SF_MID)))
    train, test = S.balanced_sample(S.train_part(s), 60).cache(), S.test_part(s).cache()
    fm = M.fit_features(train)
    return train, test, fm, fm.transform(train).cache(), fm.transform(test).cache()


@pytest.mark.parametrize("kind", ["dt", "rf", "gbt"])
def test_node_walk_and_importance_equal_mllib(spark, parts, kind):
    train, test, fm, train_x, test_x = parts
    model = M.fit_classifier(fm, train, kind, train_x)
    path = save_model(model, f"{tempfile.mkdtemp(prefix='reviewlake-test-')}/{kind}")
    assert T.is_tree_model(spark, path)
    nodes = T.node_table(spark, path, kind)
    trees = getattr(model.stages[-1], "trees", [model.stages[-1]])
    assert nodes.count() == sum(t.numNodes for t in trees)
    assert T.max_depth(nodes) == max(t.depth for t in trees)
    mine = {r.event_id: r for r in T.walk_scores(nodes, test_x, boosted=kind == "gbt").collect()}
    theirs = M.score(model, test).select("event_id", "prediction", "score").collect()
    assert len(mine) == len(theirs) > 40
    for r in theirs:
        assert mine[r.event_id].prediction == r.prediction
        assert mine[r.event_id].probability == pytest.approx(r.score, abs=1e-12)
    want = {i: v for i, v in enumerate(model.stages[-1].featureImportances.toArray()) if v}
    got = {r.feature: r.importance for r in T.importance(nodes, per_tree=kind != "gbt").collect()}
    assert got == pytest.approx(want)


def test_walk_reads_dense_vectors(spark, parts):
    from pyspark.ml.linalg import Vectors
    train, _, fm, train_x, _ = parts
    path = save_model(M.fit_classifier(fm, train, "dt", train_x), f"{tempfile.mkdtemp(prefix='reviewlake-test-')}/dt")
    nodes = T.node_table(spark, path)
    rows = train_x.select("event_id", "features").limit(5).collect()
    dense = spark.createDataFrame([(r.event_id, Vectors.dense(r.features.toArray())) for r in rows], ["event_id", "features"])
    sparse = spark.createDataFrame([(r.event_id, r.features) for r in rows], ["event_id", "features"])
    a, b = (sorted(T.walk_scores(nodes, d, ("event_id",)).collect()) for d in (dense, sparse))
    assert a == b


def test_relational_naive_bayes_equals_mllib(parts):
    train, test, fm, train_x, _ = parts
    model = M.fit_classifier(fm, train, "nb", train_x)
    label = F.when(F.col("label_text") == "positive", 1).otherwise(0)
    docs = train.withColumn("label", label)
    tf = X.doc_terms(docs, keep=("label",), parity=True)
    vocab = X.vocabulary(tf, M.VOCAB_SIZE, M.MIN_DF)
    assert [r.term for r in vocab.orderBy("rank").collect()] == fm.stages[3].vocabulary
    theta = X.nb_theta(X.tfidf(tf, vocab, docs, keep=("label",)), vocab)
    prior = B.nb_prior(docs)
    assert sorted(r.prior for r in prior.collect()) == pytest.approx(sorted(model.stages[-1].pi.toArray()))
    post = B.nb_posterior(X.tfidf(X.doc_terms(test, parity=True), vocab, docs), test, theta, prior)
    mine = {r.event_id: r for r in post.collect()}
    theirs = M.score(model, test).select("event_id", "prediction", "score", vector_to_array("rawPrediction").alias("raw")).collect()
    assert len(mine) == len(theirs)
    for r in theirs:
        got = mine[r.event_id]
        assert got.prediction == r.prediction and got.probability == pytest.approx(r.score, abs=1e-9)
        assert [got.raw_0, got.raw_1] == pytest.approx(r.raw)
    top = B.nb_importance(theta, "Naive Bayes").collect()
    want = M.feature_importance(post.sparkSession, model, "Naive Bayes").collect()
    assert [r.feature for r in top] == [r.feature for r in want]


def test_posterior_of_a_text_without_known_terms(spark):
    docs = spark.createDataFrame([(1, "a a b", 0), (2, "b c", 1), (3, "c", 1)], "event_id long, review_text string, label int")
    tf = X.doc_terms(docs, keep=("label",), stop_words=[])
    vocab = X.vocabulary(tf, 10, 1)
    theta = X.nb_theta(X.tfidf(tf, vocab, docs, keep=("label",)), vocab)
    new = spark.createDataFrame([(7, "zzz"), (8, None), (9, "")], "event_id long, review_text string")
    post = B.nb_posterior(X.tfidf(X.doc_terms(new, stop_words=[]), vocab, docs), new, theta, B.nb_prior(docs)).collect()
    assert sorted(r.event_id for r in post) == [7, 8, 9]
    assert all(r.prediction == 1.0 and r.probability == pytest.approx(0.6) for r in post)


def test_gradient_vanishes_at_the_fit_and_only_there(spark, parts):
    train, _, fm, train_x, _ = parts
    # to convergence: a fit stopped early leaves a rest
    from pyspark.ml.classification import LogisticRegression
    clf = LogisticRegression(maxIter=500, tol=1e-12, regParam=0.01).fit(train_x)
    scored = clf.transform(train_x).withColumn("probability", vector_to_array("probability")[1])
    coef = lambda shift: spark.createDataFrame(
        [(i, float(v) + shift) for i, v in enumerate(clf.coefficients.toArray())], "index int, value double")
    g = G.logistic_gradient(scored, coef(0.0), 0.01)
    worst = g.agg(F.max(F.abs("gradient"))).first()[0]
    assert worst < 1e-5
    assert G.logistic_gradient(scored, coef(0.5), 0.01).agg(F.max(F.abs("gradient"))).first()[0] > 100 * worst
    # sums by label are those of the features
    total = train_x.select(F.sum(F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x))).first()[0]
    slots = g.where("index >= 0").agg(F.sum(F.col("weight_0") + F.col("weight_1"))).first()[0]
    assert slots == pytest.approx(total)


def test_numeric_features_do_not_read_test_labels(spark):
    """App ratios of the scored rows come from the training rows: other test labels change nothing."""
    r = reviews(spark, SF_MID).withColumn("label_text", F.col("sentiment"))
    s = S.hash_split(r)
    train, test = S.train_part(s), S.test_part(s)
    flipped = test.withColumn("sentiment", F.when(F.col("sentiment") == "positive", "negative").otherwise("positive"))
    a, b = (sorted(X.with_numeric(t, train).select("event_id", *X.NUMERIC_FEATURES).collect()) for t in (test, flipped))
    assert a == b and len(a) > 40
    model = M.train_lr_numeric(S.balanced_sample(train, 40))
    scores = lambda t: sorted(M.score(model, X.with_numeric(t, train)).select("event_id", "score").collect())
    assert scores(test) == scores(flipped.withColumn("label_text", F.lit("positive")))
    unseen = X.with_numeric(test.withColumn("app_id", F.lit(-5)), train)
    assert unseen.where("app_review_count IS NULL").count() == test.count()
    assert M.score(model, unseen).count() == test.count()
