"""Term counts inside the row, length histograms, grouped curves: against their plain forms."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewlake.operators import evaluate as V
from reviewlake.operators import features as X
from reviewlake.operators import profile as P
from tests.conftest import SF_SMALL
from tests.util import rows
from tools.plan_report import summarise


@settings(max_examples=20, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), st.text(alphabet="ab The\t\n é", max_size=30)), min_size=1, max_size=6))
def test_doc_terms_equal_grouped_counts(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "event_id long, review_text string")
    want = X.term_frequencies(X.terms(df))
    assert rows(X.doc_terms(df).toPandas()) == rows(want.toPandas())
    words = X.remove_stopwords(X.tokenize(df.where("review_text IS NOT NULL"), parity=True))
    parity = words.select("event_id", F.explode("filtered_words").alias("term")).groupBy("event_id", "term").agg(
        F.count(F.lit(1)).alias("tf"))
    assert rows(X.doc_terms(df, parity=True).toPandas()) == rows(parity.toPandas())


def test_doc_terms_shuffle_nothing_and_keep_repeated_rows(spark):
    df = spark.createDataFrame([(1, "x x y"), (1, "x x y"), (None, "y")], "event_id long, review_text string")
    made = X.doc_terms(df)
    qe = made._jdf.queryExecution()
    qe.toRdd().count()
    assert summarise(qe.executedPlan().toString())["shuffles"] == 0
    assert sorted((r.event_id or 0, r.term, r.tf) for r in made.collect()) == [
        (0, "y", 1), (1, "x", 2), (1, "x", 2), (1, "y", 1), (1, "y", 1)]
    long = spark.createDataFrame([(1, " ".join(f"w{i % 500}" for i in range(200_000)))], "event_id long, review_text string")
    assert {r.tf for r in X.doc_terms(long).collect()} == {400}


@pytest.mark.parametrize("name,most", [("tfidf", 5), ("vocabulary", 3), ("idf", 4), ("nb_theta", 9),
                                       ("compare_thresholds", 20), ("length_stats", 5)])
def test_exchanges(spark, name, most):
    from reviewlake.plans import QUERIES
    df = QUERIES[name](spark, SF_SMALL)
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    plan = qe.executedPlan().toString()
    assert summarise(plan)["shuffles"] <= most
    assert "hashpartitioning(event_id#" not in "".join(x for x in plan.split("\n") if "term" in x and "Exchange" in x)


def test_length_reports_of_merged_batches_equal_the_whole(spark):
    data = [("a", None), ("a", ""), ("a", "xx"), ("b", "y" * 7), ("b", "y" * 7), ("b", "z"), ("c", None), (None, "q")]
    df = spark.createDataFrame(data * 3, "sentiment string, review_text string")
    whole = P.length_counts(df)
    parts = [P.length_counts(spark.createDataFrame(data, df.schema)) for _ in range(3)]
    merged = P.merge_length_counts(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    for report in (P.length_stats_of, P.length_quantiles_of, P.length_summary_of):
        assert rows(report(whole).toPandas()) == rows(report(merged).toPandas())
    stats = {r.sentiment: r for r in P.length_stats(df).collect()}
    plain = df.groupBy("sentiment").agg(
        F.count("review_text").alias("n"), F.avg(F.length("review_text")).alias("m"), F.stddev_samp(F.length("review_text")).alias("s"),
        F.percentile(F.length("review_text"), 0.5).alias("q"), F.percentile(F.length("review_text"), 0.75).alias("p")).collect()
    for r in plain:
        x = stats[r.sentiment]
        assert (x.n, x.mean_length, x.std_length, x.median_length, x.p75_length) == pytest.approx((r.n, r.m, r.s, r.q, r.p))
    assert P.length_stats(df.where("false")).count() == 0


def test_groups_are_evaluated_like_each_alone(spark):
    rng = [((i * 37) % 101) / 101 for i in range(400)]
    data = [(f"m{i % 3}", float((i * 7) % 5 > 1), s, float(s > 0.5)) for i, s in enumerate(rng)]
    data += [("one_class", 1.0, 0.3, 0.0), ("one_class", 1.0, 0.9, 1.0)]
    df = spark.createDataFrame(data, "model_name string, label double, score double, prediction double")
    got = {r.model_name: r for r in V.evaluate_groups(df).collect()}
    assert set(got) == {"m0", "m1", "m2", "one_class"}
    for name, r in got.items():
        alone = {x.metric: x.value for x in V.evaluate(df.where(F.col("model_name") == name)).collect()}
        assert r.asDict() | {"model_name": None} == pytest.approx(alone | {"model_name": None})
    assert got["one_class"].area_under_roc is None
    curves = V.roc_points(df, by=("model_name",))
    for name in ("m0", "m2"):
        alone = V.roc_points(df.where(F.col("model_name") == name))
        assert rows(curves.where(F.col("model_name") == name).drop("model_name").toPandas()) == rows(alone.toPandas())
    assert V.evaluate_groups(df.where("false")).count() == 0
    thresholds = {r.model_name: r for r in V.threshold_metrics(df, {"low": 0.2, "high": 0.7}).collect()}
    for name, t in (("low", 0.2), ("high", 0.7)):
        p = df.withColumn("prediction", F.when(F.col("score") >= t, 1.0).otherwise(0.0))
        alone = {x.metric: x.value for x in V.evaluate(p).collect()}
        assert thresholds[name].asDict() | {"model_name": None} == pytest.approx(alone | {"model_name": None})
