
import tempfile
import uuid

import duckdb
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from reviewlake.operators import clean as C
from reviewlake.operators import evaluate as V
from reviewlake.operators import features as X
from reviewlake.operators import gradient as G
from reviewlake.operators import models as M
from reviewlake.operators import sampling as S
from reviewlake.sinks.models import save_model
from reviewlake.sources.models import load_model
from reviewlake.sources.tables import reviews
from tests.conftest import SF_MID


@pytest.fixture(scope="module")
def fitted(spark):
    s = S.hash_split(C.model_frame(reviews(spark, SF_MID)))
    train, test = S.balanced_sample(S.train_part(s), 20), S.test_part(s)
    out = tempfile.mkdtemp(prefix="reviewlake-test-")
    done = M.compare_models(train, test, out, kinds=("dt", "nb"))
    models, preds = ({k: f(k) for k in ("dt", "nb")} for f in (done.model, done.predictions))
    return train, test, out, done.metrics(), models, preds


def test_a_small_training_sample_scores_every_test_row(spark, fitted):
    train, test, out, *_, preds = fitted
    assert train.count() == 40
    want = sorted(r[0] for r in test.select("event_id").collect())
    assert len(want) > 40
    for p in preds.values():
        assert sorted(r[0] for r in p.select("event_id").collect()) == want


def test_comparison_leaves_reports_models_and_records(spark, fitted):
    _, test, out, comp, _, _ = fitted
    runs = {r.run_name: r for r in spark.read.parquet(f"{out}/runs").collect()}
    assert set(runs) == {r.model_name for r in comp.collect()}
    for r in runs.values():
        assert r.start_time < r.end_time and set(r.artifacts) == {"model", "predictions", "confusion", "importance"}
        assert sum(x["count"] for x in spark.read.parquet(r.artifacts["confusion"]).collect()) == test.count()
        assert load_model(r.artifacts["model"]).stages


def test_split_is_disjoint(fitted):
    train, test, *_ = fitted
    assert S.leakage_check(train, test).count() == 0


def test_confusion_columns_equal_prediction_distribution(fitted):
    *_, preds = fitted
    for p in preds.values():
        cm = V.confusion_matrix(p).groupBy("prediction_text").agg(F.sum("count").alias("n"))
        dist = V.prediction_distribution(p)
        got = {r.prediction_text: r.n for r in cm.collect() if r.n}
        assert got == {r.prediction_text: r["count"] for r in dist.collect()}


def test_weighted_recall_equals_accuracy_and_auc_matches_mllib(fitted):
    _, _, _, comp, _, preds = fitted
    for row in comp.collect():
        assert abs(row.weighted_recall - row.accuracy) < 1e-12
        assert 0.0 <= row.area_under_roc <= 1.0
    p = preds["nb"]
    mllib = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score").evaluate(p)
    ours = V.auc(p, "label", "score").first().area_under_roc
    assert abs(ours - mllib) < 1e-9


def test_accuracy_above_majority_rate(fitted):
    _, test, _, comp, _, _ = fitted
    counts = [r["count"] for r in test.groupBy("label_text").count().collect()]
    majority = max(counts) / sum(counts)
    best = max(r.accuracy for r in comp.collect())
    assert best >= majority


def test_importance_names_come_from_vocabulary(spark, fitted):
    *_, models, _ = fitted
    vocab = {r.term for r in M.get_vocabulary(spark, models["nb"]).collect()}
    imp = M.feature_importance(spark, models["nb"], "Naive Bayes").collect()
    assert len(imp) == 30 and {r.feature for r in imp} <= vocab
    assert [r.importance for r in imp] == sorted((r.importance for r in imp), reverse=True)


def test_save_load_round_trip(spark, fitted, tmpdir_fresh):
    _, test, _, _, models, preds = fitted
    path = save_model(models["dt"], f"{tmpdir_fresh}/dt")
    again = M.score(load_model(path), test).select("event_id", "prediction", "score")
    before = preds["dt"].select("event_id", "prediction", "score")
    assert again.exceptAll(before).count() == 0 and before.exceptAll(again).count() == 0


def _reviews(spark, n, parts):
    """``n`` reviews of both classes, one of them twice, in ``parts`` partitions."""
    rows = [(i, f"word{i % 7} other{i % 5} again", "positive" if i % 3 else "negative") for i in [*range(n), 0]]
    df = spark.createDataFrame(rows, "event_id long, review_text string, label_text string")
    return df.repartition(parts, "event_id")


def _tasks(spark, fn) -> int:
    """Tasks of all jobs that ``fn`` starts."""
    sc, group = spark.sparkContext, f"tasks-{uuid.uuid4()}"
    sc.setJobGroup(group, group)
    try:
        fn()
    finally:
        sc.setJobGroup("", "")
    tracker = sc.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    return sum(i.numTasks for i in map(tracker.getStageInfo, stages) if i)


def test_a_fit_has_tasks_by_its_rows_not_by_the_inputs_splits(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")      # splits of a scan stay, too
    try:
        train = _reviews(spark, 60, 150)
        # the sample is drawn, counted and dealt again; then a task a pass
        assert {k: n for k in ("lr", "dt") if (n := _tasks(spark, lambda: getattr(M, f"train_{k}")(train))) > 1000} == {}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_comparison_reads_its_input_once_for_each_part(spark):
    seen = {k: spark.sparkContext.accumulator(0) for k in ("train", "test")}

    def counted(df, kind):
        n = seen[kind]

        def each(parts):
            for p in parts:
                n.add(p.num_rows)
                yield p
        return df.mapInArrow(each, df.schema)
    rows = _reviews(spark, 60, 3)
    M.compare_models(counted(rows, "train"), counted(rows, "test"), tempfile.mkdtemp(prefix="reviewlake-test-"), kinds=("dt", "nb"))
    assert {k: n.value for k, n in seen.items()} == {"train": 61, "test": 61}


def test_training_rows_are_the_same_rows_however_they_lie(spark):
    at = [M.training_rows(_reviews(spark, 60, parts)) for parts in (1, 40)]
    assert [x.rdd.getNumPartitions() for x in at] == [1, 1]
    assert sorted(at[0].collect()) == sorted(at[1].collect()) and at[0].count() == 61
    many = spark.range(3 * M.ROWS_PER_TASK).selectExpr("id AS event_id", "map('a', id) AS m", "cast(null AS string) AS t").coalesce(1)
    kept = M.training_rows(many)
    assert kept.rdd.getNumPartitions() == 3 and kept.count() == 3 * M.ROWS_PER_TASK
    assert M.training_rows(many.limit(0)).count() == 0


def test_a_whole_training_part_stays_as_it_lies(spark):
    rows = lambda n, parts: spark.range(n).selectExpr("id AS event_id").repartition(parts)
    tasks = lambda n, parts: (k := M.training_rows(rows(n, parts), whole=True)).rdd.getNumPartitions() * (k.distinct().count() == n)
    assert tasks(12 * M.ROWS_PER_TASK, 9) == 9          # a sample's rows are dealt to 12
    assert tasks(12 * M.ROWS_PER_TASK, 2) == M.FEW_TASKS
    assert tasks(12 * M.ROWS_PER_TASK, 40) == 12 and tasks(60, 40) == M.FEW_TASKS
    assert tasks(9 * M.MOST_ROWS_PER_TASK, 8) == 9
    assert M.training_rows(rows(60, 1).limit(0), whole=True).count() == 0


def test_lr_numeric_trains_on_the_whole_training_part(spark, monkeypatch):
    """Classes far larger than the sample the other models are fitted on: every training row counts, as in SQL."""
    import __spark_entry__ as E
    from reviewlake.plans import models_q as Q
    from tests.util import rows
    monkeypatch.setattr(Q, "SAMPLE_PER_CLASS", 5)
    at = tempfile.mkdtemp(prefix="reviewlake-test-")
    docs = [(i, f"word{i % 7} other{i % 5} Again" + " more" * (i % 11), f"src{i % 4 or 1}") for i in range(300)] + [(300, None, "src2"), (301, "", "src9")]
    spark.createDataFrame(docs, "doc_id long, text string, source string").write.parquet(f"{at}/documents.parquet")
    labels = [(d[0], int(d[0] % 3 > 0 or d[0] % 10 == 0), d[0] % 4) for d in docs]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{at}/{t}.parquet/*.parquet')")
    got, want = E.queries()["train_lr_numeric"](spark, at).toPandas(), con.execute(E.oracle_sql()["train_lr_numeric"]).df()
    assert rows(got) == rows(want) and got.at_minimum.all()
    n = got.set_index("index").loc[-1]
    assert n.weight_0 + n.weight_1 == con.execute("SELECT count(*) FROM documents WHERE text IS NOT NULL AND md5(CAST(doc_id AS VARCHAR)) < 'cccccccc'").fetchone()[0] > 200


def test_settled_intercept_where_a_feature_hardly_differs(spark):
    """A mean of 100,000 deviations: what L-BFGS leaves of the intercept's gradient counts as often in that slot."""
    from pyspark.ml.linalg import Vectors
    data = [(float((i * 7) % 13 > 4 + i % 3), Vectors.dense(1e5 + (i * 37) % 101 / 30, (i * 11) % 17 / 5)) for i in range(2000)]
    feats = spark.createDataFrame(data, ["label", "features"]).cache()
    fit = M.classifier("lr", **M.CONVERGED).fit(feats)

    def worst(clf):
        scored = clf.transform(feats).withColumn("probability", vector_to_array("probability")[1])
        at = spark.createDataFrame([(i, float(v)) for i, v in enumerate(clf.coefficients.toArray())], "index int, value double")
        return G.logistic_gradient(scored, at, clf.getRegParam()).agg(F.max(F.abs("gradient"))).first()[0]
    settled = M.settle_intercept(fit, feats)
    assert settled.coefficients == fit.coefficients and settled.getRegParam() == fit.getRegParam() and settled.uid == fit.uid
    assert worst(settled) < 1e-6 < worst(fit)
    one = M.classifier("lr").fit(feats.where("label = 1"))
    assert M.settle_intercept(one, feats.where("label = 1")).intercept == one.intercept


def test_app_numbers_are_broadcast_while_apps_are_few(spark, monkeypatch):
    df = spark.createDataFrame([(i, i % 3, f"a b{i}", "positive" if i % 2 else "negative", 1) for i in range(30)] + [(30, None, "a", "positive", 1)],
                               "event_id long, app_id int, review_text string, sentiment string, review_votes int")
    plan = lambda d: d._jdf.queryExecution().sparkPlan().toString()
    few = X.with_numeric(df, df)
    assert "BroadcastHashJoin" in plan(few)
    monkeypatch.setattr(X, "MAX_BROADCAST_GROUPS", 2)
    many = X.with_numeric(df, df)
    assert "BroadcastHashJoin" not in plan(many)
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect())) and few.count() == 31
    assert few.where("app_id IS NULL").first().app_review_count is None
