"""Batches published once, jobs resumed after a lost driver, streams bounded by bytes."""

import pytest
from pyspark.sql import functions as F

from reviewlake.operators import clean as C
from reviewlake.operators import models as M
from reviewlake.operators import sampling as S
from reviewlake.sinks.manifest import commit, committed, fingerprint, step
from reviewlake.sinks.stream import publish_events, published_batches
from reviewlake.sources.tables import reviews
from reviewlake.streaming.pipeline import stream_source, write_dedup
from tests.conftest import SF_MID, SF_SMALL


def events(spark, ids):
    df = spark.createDataFrame([(i, 10 * i) for i in ids], "event_id long, app_id int")
    return df.selectExpr("event_id", "'review' AS event_type", "'t' AS timestamp", "app_id", "'n' AS app_name",
                         "'x' AS review_text", "1 AS review_score", "0 AS review_votes", "'positive' AS sentiment")


def test_a_batch_is_published_once(spark, tmpdir_fresh):
    topic = f"{tmpdir_fresh}/topic"
    assert publish_events(events(spark, [1, 2]), topic, batch_id="7")
    assert not publish_events(events(spark, [1, 2]), topic, batch_id="7")
    assert publish_events(events(spark, [3]), topic, batch_id="1e5")
    assert published_batches(spark, topic) == ["1e5", "7"]
    assert publish_events(events(spark, [4]), topic) and len(published_batches(spark, topic)) == 3
    src = stream_source(spark, topic)
    assert "batch" not in src.columns
    q = src.writeStream.format("parquet").option("checkpointLocation", f"{tmpdir_fresh}/c").trigger(availableNow=True).start(f"{tmpdir_fresh}/o")
    q.awaitTermination()
    assert sorted(r.offset for r in spark.read.parquet(f"{tmpdir_fresh}/o").collect()) == [1, 2, 3, 4]


def test_a_publisher_that_dies_leaves_nothing(spark, tmpdir_fresh):
    topic = f"{tmpdir_fresh}/topic"
    bad = events(spark, [1]).withColumn("review_score", F.expr("assert_true(false, 'lost')").cast("int"))
    with pytest.raises(Exception, match="lost"):
        publish_events(bad, topic, batch_id="a")
    assert published_batches(spark, topic) == []
    assert publish_events(events(spark, [1]), topic, batch_id="a")


def test_a_batch_is_bounded_by_bytes_or_files(spark, tmpdir_fresh):
    for i in range(4):
        publish_events(events(spark, [i]).coalesce(1), f"{tmpdir_fresh}/topic", batch_id=str(i))
    src = stream_source(spark, f"{tmpdir_fresh}/topic", max_bytes_per_trigger=1)
    q = src.writeStream.format("noop").option("checkpointLocation", f"{tmpdir_fresh}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p.numInputRows]) == 4      # one file a batch at least
    with pytest.raises(ValueError):
        stream_source(spark, tmpdir_fresh, max_bytes_per_trigger=1, max_files_per_trigger=1)


def test_dedup_goes_on_after_a_restart(spark, tmpdir_fresh):
    import datetime as dt
    src, t0 = f"{tmpdir_fresh}/src", dt.datetime(2024, 1, 1)
    schema = spark.createDataFrame([], "event_id long, event_time timestamp").schema

    def arrive(*ids):
        rows = [(i, t0 + dt.timedelta(minutes=10 * i)) for i in ids]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        return write_dedup(stream_source(spark, src, "parquet", schema=schema), f"{tmpdir_fresh}/o", f"{tmpdir_fresh}/c")
    arrive(1, 1, 2)
    arrive(2, 3, 3)
    arrive(3, 4)
    assert sorted(r.event_id for r in spark.read.parquet(f"{tmpdir_fresh}/o").collect()) == [1, 2, 3, 4]


def test_a_step_runs_once_under_its_key(spark, tmpdir_fresh):
    ran = []
    folder = f"{tmpdir_fresh}/s"
    assert committed(spark, folder) is None
    for key in ("a", "a", "b", "a"):
        assert step(spark, folder, key, lambda: ran.append(key) or {"made": key}) == {"made": key}
    assert ran == ["a", "b", "a"]
    with pytest.raises(ZeroDivisionError):
        step(spark, f"{tmpdir_fresh}/t", "k", lambda: 1 / 0)
    assert committed(spark, f"{tmpdir_fresh}/t") is None
    commit(spark, folder, {"x": "é\n"}, "c")
    assert committed(spark, folder, "c") == {"x": "é\n"} and committed(spark, folder, "a") is None


def test_fingerprint_sees_files_and_parameters(spark, tmpdir_fresh):
    path = f"{tmpdir_fresh}/t"
    spark.range(3).write.parquet(path)
    one = fingerprint(spark, [path], n=1)
    assert one == fingerprint(spark, [path], n=1) != fingerprint(spark, [path], n=2)
    spark.range(4).write.mode("overwrite").parquet(path)
    assert one != fingerprint(spark, [path], n=1)
    assert len(fingerprint(spark, [f"{SF_SMALL}/documents.parquet"])) == 32


def test_a_killed_comparison_fits_only_what_is_missing(spark, tmpdir_fresh, monkeypatch):
    s = S.hash_split(C.model_frame(reviews(spark, SF_MID)))
    train, test = S.balanced_sample(S.train_part(s), 20), S.test_part(s)
    kinds = ("lr", "dt", "rf", "gbt", "nb")
    real, fitted = M.fit_classifier, []

    def dies(fm, train, kind, *rest):
        if len(fitted) == 2:
            raise KeyboardInterrupt("killed")
        fitted.append(kind)
        return real(fm, train, kind, *rest)
    monkeypatch.setattr(M, "fit_classifier", dies)
    with pytest.raises(KeyboardInterrupt):
        M.compare_models(train, test, tmpdir_fresh, kinds, parallel=False, key="k")
    assert committed(spark, tmpdir_fresh) is None and fitted == ["lr", "dt"]
    first = {k: committed(spark, f"{tmpdir_fresh}/{k}", "k") for k in fitted}

    monkeypatch.setattr(M, "fit_classifier", lambda fm, train, kind, *rest: fitted.append(kind) or real(fm, train, kind, *rest))
    done = M.compare_models(train, test, tmpdir_fresh, kinds, parallel=False, key="k")
    assert fitted == list(kinds)
    assert {k: committed(spark, f"{tmpdir_fresh}/{k}", "k") for k in first} == first
    assert sorted(r.model_name for r in done.metrics().collect()) == sorted(M.MODEL_NAMES.values())
    assert done.runs().count() == 5 and done.predictions("rf").count() == test.count()
    # all there: nothing is fitted; other inputs: everything is
    M.compare_models(train, test, tmpdir_fresh, kinds, key="k")
    assert fitted == list(kinds)
    M.compare_models(train, test, tmpdir_fresh, ("nb",), key="other")
    assert fitted[len(kinds):] == ["nb"]
