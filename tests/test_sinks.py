"""Side-effecting sinks and stream helpers (unit tests)."""

import datetime as dt

from reviewlake.operators import profile as P
from reviewlake.sinks.models import save_model, track_run
from reviewlake.sinks.tables import latest_snapshot, read_silver, write_report, write_silver
from reviewlake.sources.models import load_model
from reviewlake.sources.tables import reviews
from reviewlake.streaming.pipeline import dedup_stream
from tests.conftest import SF_SMALL


def test_write_report_single_csv(spark, tmpdir_fresh):
    rep = P.sentiment_distribution(reviews(spark, SF_SMALL))
    write_report(rep, f"{tmpdir_fresh}/rep")
    back = spark.read.option("header", True).csv(f"{tmpdir_fresh}/rep")
    assert back.rdd.getNumPartitions() == 1
    assert sorted((r.sentiment, int(r["count"])) for r in back.collect()) == \
        sorted((r.sentiment, r["count"]) for r in rep.collect())


def test_silver_snapshots_read_newest(spark, tmpdir_fresh):
    row = (1, "t", "x", 1, "a", "txt", 1, 0, "positive", None, None, "{}", None)
    schema = ("event_id long, event_type string, timestamp string, app_id int, app_name string, "
              "review_text string, review_score int, review_votes int, sentiment string, "
              "event_time timestamp, reject_reason string, raw_json string, _corrupt_record string")
    df1 = spark.createDataFrame([row], schema)
    df2 = spark.createDataFrame([row, (2,) + row[1:]], schema)
    root = f"{tmpdir_fresh}/silver"
    write_silver(df1, root)
    import time
    time.sleep(0.01)
    v2 = write_silver(df2, root)
    assert latest_snapshot(spark, root) == v2
    assert read_silver(spark, root).count() == 2


def test_track_run_and_model_round_trip(spark, tmpdir_fresh):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer
    df = reviews(spark, SF_SMALL)
    model = Pipeline(stages=[StringIndexer(inputCol="sentiment", outputCol="label")]).fit(df)
    path = save_model(model, f"{tmpdir_fresh}/m")
    again = load_model(path)
    assert again.stages[0].labels == model.stages[0].labels
    t0 = dt.datetime(2024, 1, 1)
    track_run(spark, f"{tmpdir_fresh}/runs", "r1", {"a": "1"}, {"acc": 0.5}, {"model": path}, t0)
    track_run(spark, f"{tmpdir_fresh}/runs", "r2", {}, {"acc": 0.7}, {}, t0)
    runs = spark.read.parquet(f"{tmpdir_fresh}/runs")
    assert sorted(r.run_name for r in runs.collect()) == ["r1", "r2"]


def test_dedup_stream_drops_repeats(spark, tmpdir_fresh):
    src = f"{tmpdir_fresh}/src"
    rows = [(1, dt.datetime(2024, 1, 1, 10)), (1, dt.datetime(2024, 1, 1, 10, 5)),
            (2, dt.datetime(2024, 1, 1, 10, 1))]
    spark.createDataFrame(rows, "event_id long, event_time timestamp").write.parquet(src)
    stream = spark.readStream.schema("event_id long, event_time timestamp").parquet(src)
    q = (dedup_stream(stream).writeStream.format("parquet").option("checkpointLocation", f"{tmpdir_fresh}/c")
         .trigger(availableNow=True).start(f"{tmpdir_fresh}/out"))
    q.awaitTermination()
    out = spark.read.parquet(f"{tmpdir_fresh}/out")
    assert sorted(r.event_id for r in out.collect()) == [1, 2]


def test_silver_stream_batches_are_idempotent(spark, tmpdir_fresh):
    import json
    from reviewlake.operators.clean import bronze_project
    from reviewlake.streaming.pipeline import silver_stream
    ev = {"event_id": 1, "event_type": "r", "timestamp": "2024-01-01T00:00:00+00:00", "app_id": 1,
          "app_name": "a", "review_text": "t", "review_score": 1, "review_votes": 0,
          "sentiment": "positive"}
    rec = "key string, value string, topic string, partition int, offset long, timestamp timestamp"
    rows = [("1", json.dumps({**ev, "event_id": i}), "t", 0, i, dt.datetime(2024, 1, 1)) for i in range(4)]
    rows.append(("1", "not json", "t", 0, 9, dt.datetime(2024, 1, 1)))
    bronze = f"{tmpdir_fresh}/bronze"
    bronze_project(spark.createDataFrame(rows, rec)).write.parquet(bronze)
    schema = spark.read.parquet(bronze).schema
    for _ in range(2):  # a rerun finds nothing new
        silver_stream(spark.readStream.schema(schema).parquet(bronze), f"{tmpdir_fresh}/silver",
                      f"{tmpdir_fresh}/rejects", f"{tmpdir_fresh}/ckpt")
    assert spark.read.parquet(f"{tmpdir_fresh}/silver").count() == 4
    assert spark.read.parquet(f"{tmpdir_fresh}/rejects").count() == 1


def test_hourly_trend_stream_drops_rows_behind_the_watermark(spark, tmpdir_fresh):
    from reviewlake.streaming.pipeline import hourly_trend_stream
    src = f"{tmpdir_fresh}/src"
    t = dt.datetime
    first = [(t(2024, 1, 1, 10, 5),), (t(2024, 1, 1, 11, 10),), (t(2024, 1, 1, 13, 30),)]
    # after batch 1 the watermark is 13:30 - 1h = 12:30: hour 10 is closed, so
    # the 10:40 row is late (dropped); 12:45 is still on time
    second = [(t(2024, 1, 1, 10, 40),), (t(2024, 1, 1, 12, 45),), (t(2024, 1, 1, 15, 0),)]
    schema = "event_time timestamp"
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(f"{src}/a")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(f"{src}/*")
    out, ck = f"{tmpdir_fresh}/out", f"{tmpdir_fresh}/ck"

    def run():
        q = (hourly_trend_stream(stream, "event_time", "1 hour").writeStream.format("parquet")
             .option("checkpointLocation", ck).outputMode("append")
             .trigger(availableNow=True).start(out))
        q.awaitTermination()

    run()
    spark.createDataFrame(second, schema).coalesce(1).write.parquet(f"{src}/b")
    run()
    got = {r.hour.hour: r["count"] for r in spark.read.parquet(out).orderBy("hour").collect()}
    # final watermark 15:00 - 1h = 14:00: windows ending by then (10..13) are
    # emitted, hour 15 stays open in state; hour 10 kept its single on-time row
    assert got == {10: 1, 11: 1, 12: 1, 13: 1}


def test_silver_rejects_partition_and_column_pruning(spark, tmpdir_fresh):
    import json
    from reviewlake.operators.clean import bronze_project, tag_events
    from reviewlake.sources.tables import scan_columns
    ev = {"event_id": 1, "event_type": "r", "timestamp": "2024-01-01T00:00:00+00:00", "app_id": 1,
          "app_name": "a", "review_text": "t", "review_score": 1, "review_votes": 0,
          "sentiment": "positive"}
    rec = "key string, value string, topic string, partition int, offset long, timestamp timestamp"
    rows = [("1", json.dumps({**ev, "event_id": i}), "t", 0, i, dt.datetime(2024, 1, 1)) for i in range(3)]
    rows += [("1", json.dumps({**ev, "sentiment": "neutral"}), "t", 0, 7, dt.datetime(2024, 1, 1))]
    tagged = tag_events(bronze_project(spark.createDataFrame(rows, rec)))
    root = f"{tmpdir_fresh}/silver"
    write_silver(tagged, root, partitions=2)
    rej = read_silver(spark, root, status="rejected").collect()
    assert [r.reject_reason for r in rej] == ["invalid_sentiment"]
    cols = scan_columns(spark, root, ["event_id", "app_id"]).where("status = 'valid'")
    plan = cols._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,app_id:int>" in plan
    assert "PartitionFilters: [isnotnull(status" in plan
    assert cols.count() == 3
