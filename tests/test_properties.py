"""Properties: layout independence, exactness vs brute force, MLlib equality, plans."""

import hashlib
import re

import pytest

from pyspark.ml.classification import NaiveBayes
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import CountVectorizer, HashingTF, IDF, StopWordsRemover
from pyspark.sql import functions as F

from reviewlake.operators import clean as C
from reviewlake.operators import evaluate as V
from reviewlake.operators import features as X
from reviewlake.operators import profile as P
from reviewlake.operators import sampling as S
from reviewlake.plans.features_q import labelled
from reviewlake.schemas import STOP_WORDS_EN
from reviewlake.sources.tables import reviews, scored, table
from tests.conftest import SF_MID, SF_SMALL


def _ids(df, col="event_id"):
    return sorted(r[0] for r in df.select(col).collect())


def test_stop_words_constant_equals_mllib(spark):
    assert STOP_WORDS_EN == StopWordsRemover.loadDefaultStopWords("english")


def test_sampling_is_layout_independent(spark):
    rv = reviews(spark, SF_MID)
    mf = C.model_frame(rv)
    results = set()
    for n in (1, 4, 7):
        r = mf.repartition(n)
        results.add((tuple(_ids(S.balanced_sample(r, 30))),
                     tuple(_ids(S.train_part(S.hash_split(r)))),
                     tuple(_ids(S.per_group_sample(rv.repartition(n), 3, "app_id")))))
    assert len(results) == 1


def test_hash_top_n_matches_brute_force_with_hot_group(spark):
    # group 0 holds a third of the rows; n cuts inside every group
    n_rows = 3000
    rows = [(i, 0 if i % 3 == 0 else i % 17) for i in range(n_rows)]
    df = spark.createDataFrame(rows, "k long, g int").repartition(5)
    got = {(r.k, r.g) for r in S.hash_top_n(df, 40, ["k"], ["g"]).collect()}
    by_g = {}
    for k, g in rows:
        by_g.setdefault(g, []).append((hashlib.md5(str(k).encode()).hexdigest(), k))
    want = {(k, g) for g, lst in by_g.items() for _, k in sorted(lst)[:40]}
    assert got == want
    # no group: global first n
    got1 = {r.k for r in S.sample_n(df, 123, "k").collect()}
    allh = sorted((hashlib.md5(str(k).encode()).hexdigest(), k) for k, _ in rows)
    assert got1 == {k for _, k in allh[:123]}


def test_split_disjoint_and_exhaustive(spark):
    r = reviews(spark, SF_MID).select("event_id")
    s = S.hash_split(r)
    train, test = S.train_part(s), S.test_part(s)
    assert train.count() + test.count() == r.count()
    assert S.leakage_check(train, test).count() == 0
    assert S.exclude_training(r, train).count() == test.count()


@pytest.mark.parametrize("cores", [1, 4, 7])
def test_seq_id_in_file_order(spark, tmpdir_fresh, cores):
    """A small file before a large one: splits are packed by size, ids go by file."""
    spark.range(1000).coalesce(1).write.parquet(f"{tmpdir_fresh}/t/a")
    spark.range(1000, 60000).coalesce(1).write.parquet(f"{tmpdir_fresh}/t/b")
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(400_000 // cores))
    try:
        ids = C.seq_id(spark.read.parquet(f"{tmpdir_fresh}/t/a", f"{tmpdir_fresh}/t/b"), "seq")
        assert ids.where("seq <> id + 1").count() == 0 and ids.count() == 60000
        assert {r.id for r in C.cap_rows(ids, 1500, "seq").collect()} == set(range(1500))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)


def test_profile_invariants(spark):
    r = reviews(spark, SF_MID)
    total = r.count()
    assert sum(x["count"] for x in P.sentiment_distribution(r).collect()) == total
    assert sum(x["count"] for x in P.hourly_trend(P.text_length(r).withColumn(
        "event_time", F.current_timestamp())).collect()) == total
    by_class = {x.sentiment: x.review_count for x in P.text_length_summary(r).collect()}
    assert by_class == {x.sentiment: x["count"] for x in P.sentiment_distribution(r).collect()}
    scores = {x.review_score: x["count"] for x in P.score_distribution(r).collect()}
    assert scores[-1] == by_class["negative"] and scores[1] == by_class["positive"]


def test_auc_equals_mllib_and_bruteforce(spark):
    s = scored(spark, SF_MID)
    ours = V.auc(s).first().area_under_roc
    mllib = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score").evaluate(
        s.withColumn("label", F.col("label").cast("double")))
    assert abs(ours - mllib) < 1e-12
    pdf = s.toPandas()
    pos, neg = pdf[pdf.label == 1].score.values, pdf[pdf.label == 0].score.values
    brute = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (
        len(pos) * len(neg))
    assert abs(ours - brute) < 1e-12


def test_roc_equals_one_global_running_sum(spark):
    """Scores of any size, also negative, infinite and equal ones."""
    from pyspark.sql import Window
    scores = [0.0, -0.0, 1.0, -3.5, 1e300, float("inf"), float("-inf"), 0.25, 0.25, 1e-12, 2e-12, 7.0]
    s = spark.createDataFrame([(i % 2, x) for i, x in enumerate(scores)], "label int, score double").unionByName(
        scored(spark, SF_MID).select("label", "score"))
    got = V.roc_table(s).select("score", "tp", "fp").collect()
    w = Window.orderBy(F.desc("score"))
    want = (s.groupBy((F.col("score") + 0.0).alias("score"))
            .agg(F.sum("label").alias("p"), F.count("label").alias("n"))
            .select("score", F.sum("p").over(w).alias("tp"), (F.sum("n").over(w) - F.sum("p").over(w)).alias("fp")).collect())
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert len(V.roc_points(s, bins=50).collect()) <= 53


def test_auc_of_very_many_rows(spark, monkeypatch):
    """More than 4e9 rows of each class: the product of the counts is no long."""
    table = spark.range(2).select(F.col("id").cast("double").alias("score"), *[F.lit(5 * 10 ** 9).alias(c) for c in ("pos", "neg")],
                                  (F.lit(5 * 10 ** 9) * (2 - F.col("id"))).alias("tp"))
    monkeypatch.setattr(V, "roc_table", lambda *a, **b: table)
    assert V.auc(None).first()[0] == 0.5


def test_evaluate_equals_mllib_multiclass(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    s = scored(spark, SF_MID).withColumn("label", F.col("label").cast("double")) \
        .withColumn("prediction", F.when(F.col("score") >= 0.5, 1.0).otherwise(0.0))
    ours = {r.metric: r.value for r in V.evaluate(s).collect()}
    for name, metric in [("accuracy", "accuracy"), ("f1_score", "f1"),
                         ("weighted_precision", "weightedPrecision"),
                         ("weighted_recall", "weightedRecall")]:
        want = MulticlassClassificationEvaluator(metricName=metric).evaluate(s)
        assert abs(ours[name] - want) < 1e-12, name


def _small_corpus(spark):
    c = labelled(spark, SF_SMALL)
    return c, X.term_frequencies(X.terms(c, keep=("label",)), keep=("label",))


def test_terms_equal_array_pipeline(spark):
    c, _ = _small_corpus(spark)
    arr = X.remove_stopwords(X.tokenize(c)).select("event_id", F.explode("filtered_words").alias("term"))
    flat = X.terms(c).select("event_id", "term")
    assert arr.exceptAll(flat).count() == 0 and flat.exceptAll(arr).count() == 0


def test_relational_nb_theta_equals_mllib(spark):
    c, tf = _small_corpus(spark)
    vocab = X.vocabulary(tf, vocab_size=5000, min_df=2)
    rel = {(r.label, r.term): r.theta for r in X.nb_theta(
        X.tfidf(tf, vocab, c, keep=("label",)), vocab).collect()}
    # MLlib on the same vocabulary order
    terms = [r.term for r in vocab.orderBy("rank").collect()]
    from pyspark.ml.feature import CountVectorizerModel
    toks = X.remove_stopwords(X.tokenize(c))
    cv = CountVectorizerModel.from_vocabulary(terms, inputCol="filtered_words", outputCol="tf")
    tfv = cv.transform(toks)
    feats = IDF(inputCol="tf", outputCol="features").fit(tfv).transform(tfv) \
        .withColumn("label", F.col("label").cast("double"))
    theta = NaiveBayes(smoothing=1.0).fit(feats).theta.toArray()
    for (label, term), v in rel.items():
        assert abs(theta[label][terms.index(term)] - v) < 1e-9


def test_relational_hashing_tf_equals_mllib(spark):
    c, _ = _small_corpus(spark)
    toks = X.remove_stopwords(X.tokenize(c))
    rel = {(r.event_id, r["index"]): r.tf for r in X.hashing_tf(toks, num_features=1000).collect()}
    h = HashingTF(inputCol="filtered_words", outputCol="v", numFeatures=1000).transform(toks)
    ml = {}
    for r in h.select("event_id", "v").collect():
        for i, v in zip(r.v.indices, r.v.values):
            ml[(r.event_id, int(i))] = v
    assert rel == ml


def test_vocabulary_matches_countvectorizer_counts(spark):
    c, tf = _small_corpus(spark)
    rel = X.vocabulary(tf, vocab_size=50, min_df=2).collect()
    toks = X.remove_stopwords(X.tokenize(c))
    model = CountVectorizer(inputCol="filtered_words", outputCol="v", vocabSize=50, minDF=2.0).fit(toks)
    # same term set except possibly at a tie on the last count
    last = rel[-1].term_count
    assert {r.term for r in rel if r.term_count > last} <= set(model.vocabulary)


def test_probability_columns_without_python_udf(spark):
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(Vectors.dense([0.25, 0.75]),)], ["probability"])
    out = C.probability_columns(df)
    r = out.first()
    assert (r.probability_negative, r.probability_positive) == (0.25, 0.75)
    assert "PythonUDF" not in out._jdf.queryExecution().executedPlan().toString()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns_and_pushes_filters(spark):
    r = reviews(spark, SF_MID)
    plan = _plan(P.score_distribution(r))
    assert "ReadSchema: struct<doc_id:bigint>" in plan        # no text column read
    plan2 = _plan(S.test_part(S.hash_split(table(spark, SF_MID, "events").where(
        F.col("value") > 10.0).select("event_id"))))
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,10.0)]" in plan2


def _unpartitioned_windows(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [ln for ln in plan.splitlines() if "Window [" in ln and re.search(r"\], \[\], \[", ln)]


def test_sampling_has_no_unpartitioned_window(spark):
    rv = reviews(spark, SF_MID)
    for df in (S.balanced_sample(C.model_frame(rv), 30), S.per_group_sample(rv, 3, "app_id")):
        assert _unpartitioned_windows(df) == []


def test_hash_prefiltered_joins_equal_plain_joins(spark):
    rows_a = [(1, "x"), (2, "y"), (3, None), (4, "x"), (5, "zz")]
    rows_b = [(10, "x"), (11, None), (12, "q"), (13, "x")]
    a = spark.createDataFrame(rows_a, "event_id long, review_text string")
    b = spark.createDataFrame(rows_b, "event_id long, review_text string")
    semi = a.join(b.select("review_text"), "review_text", "left_semi")
    anti = a.join(b.select("review_text"), "review_text", "left_anti")
    assert _ids(S.leakage_check(b, a, "review_text")) == _ids(semi) == [1, 4]
    assert _ids(S.exclude_training(a, b, "review_text")) == _ids(anti) == [2, 3, 5]


def test_exact_percentiles_equal_spark_percentile(spark):
    import random
    rnd = random.Random(7)
    rows = [("hot", rnd.randint(0, 50)) for _ in range(3000)] + \
           [("cold", rnd.randint(0, 1000)) for _ in range(37)] + [("one", 5)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(6)
    probs = (0.0, 0.25, 0.5, 0.75, 0.9, 1.0)
    ours = {r.g: [r[f"q{i}"] for i in range(len(probs))] for r in
            P.exact_percentiles(df, F.col("v"), probs, ("g",), "q").collect()}
    want = {r.g: list(r.q) for r in df.groupBy("g").agg(
        F.percentile("v", F.array(*[F.lit(p) for p in probs])).alias("q")).collect()}
    assert ours.keys() == want.keys()
    for g in ours:
        assert all(abs(a - b) < 1e-9 for a, b in zip(ours[g], want[g])), g


def test_hash_top_n_two_level_path_matches_brute_force(spark):
    # group 0: 100k rows (forces the second histogram level for small n);
    # group 1: 30 rows (k1 = 0 when n=3); group 2: 2 rows (fewer than n)
    rows = [(i, 0) for i in range(100_000)] + [(200_000 + i, 1) for i in range(30)] + \
           [(300_000, 2), (300_001, 2)]
    df = spark.createDataFrame(rows, "k long, g int").repartition(7)
    by_g = {}
    for k, g in rows:
        by_g.setdefault(g, []).append((hashlib.md5(str(k).encode()).hexdigest(), k))
    for n in (1, 3):
        got = {(r.k, r.g) for r in S.hash_top_n(df, n, ["k"], ["g"]).collect()}
        want = {(k, g) for g, lst in by_g.items() for _, k in sorted(lst)[:n]}
        assert got == want, n


def test_hash_top_n_treats_null_group_as_a_group(spark):
    rows = [(i, None) for i in range(50)] + [(100 + i, 1) for i in range(50)]
    df = spark.createDataFrame(rows, "k long, g int")
    got = S.hash_top_n(df, 5, ["k"], ["g"]).groupBy("g").count().collect()
    assert sorted((r.g if r.g is not None else -1, r["count"]) for r in got) == [(-1, 5), (1, 5)]


def test_numeric_features_use_training_rows_only(spark):
    r = reviews(spark, SF_MID)
    s = S.hash_split(r)
    train = S.train_part(s)
    feats = X.numeric_features(S.test_part(s), train).collect()
    counts = {row.app_id: row["count"] for row in train.groupBy("app_id").count().collect()}
    app_of = {row.event_id: row.app_id for row in S.test_part(s).select("event_id", "app_id").collect()}
    for f in feats:
        assert f.app_review_count == counts.get(app_of[f.event_id])


def test_optional_paths_agree_with_exact(spark):
    r = reviews(spark, SF_MID)
    exact = {x.sentiment: x for x in P.length_stats(r).collect()}
    approx = {x.sentiment: x for x in P.length_stats(r, exact=False).collect()}
    for k, e in exact.items():  # the sketch returns a data value near the exact quantile
        assert abs(approx[k].median_length - e.median_length) <= 0.02 * e.median_length + 1
    hll = {x.metric: x.value for x in P.basic_summary(r, approx=True).collect()}
    ex = {x.metric: x.value for x in P.basic_summary(r).collect()}
    assert hll == ex  # 20 apps, 2 classes: HyperLogLog++ is exact at this size
    everyone = P.top_apps_by_votes(r, 5, candidates=None, min_reviews=1).collect()
    pool = P.top_apps_by_votes(r, 5, candidates=20).collect()
    assert max(x.avg_review_votes for x in everyone) >= max(x.avg_review_votes for x in pool)
