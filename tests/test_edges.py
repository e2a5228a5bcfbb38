"""Hand-written edge fixtures (FIXTURES.md section 4)."""

import datetime as dt
import json
import os

import pytest
from pyspark.ml.feature import Tokenizer
from pyspark.sql import Row
from pyspark.sql import functions as F

from reviewlake.operators import clean as C
from reviewlake.operators import evaluate as V
from reviewlake.operators import features as X
from reviewlake.operators import profile as P
from reviewlake.schemas import SILVER_COLUMNS
from reviewlake.sources.csv import scan_reviews_csv
from reviewlake.streaming.pipeline import stream_source, stream_to_bronze

CSV_EDGE = (
    "app_id,app_name,review_text,review_score,review_votes\n"
    '1,Game A,"line one\nline two",1,3\n'
    '2,"Game ""B""","he said ""hi""",1,0\n'
    "3,N/A,fine,1,1\n"
    "4,Game D,NA,-1,2\n"
    "5,Game E,text,1,\n"
    '6,Game F,"\t padded ",1,1\n'
    "7,Game G,zero,0,1\n"
    "8,Game H,no score,,1\n"
    ",Game I,no app,1,1\n"
)


def test_csv_edge(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "edge.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write(CSV_EDGE)
    raw = scan_reviews_csv(spark, p)
    ev = C.build_event(C.seq_id(raw)).orderBy("event_id").collect()
    assert [r.event_id for r in ev] == list(range(1, 10))
    by = {r.event_id: r for r in ev}
    assert by[1].review_text == "line one\nline two"
    assert by[2].app_name == 'Game "B"' and by[2].review_text == 'he said "hi"'
    assert by[3].app_name == ""            # N/A -> missing -> ""
    assert by[4].review_text == ""         # NA -> missing -> ""
    assert by[5].review_votes == 0         # empty votes -> 0
    assert by[6].review_text == "padded"   # tab and no-break space stripped
    assert by[7].sentiment == "negative" and by[7].review_score == 0
    assert by[8].reject_reason == "invalid_review_score"
    assert by[9].reject_reason == "invalid_app_id"
    assert all(by[i].reject_reason is None for i in range(1, 8))


def _bronze(spark, values):
    rows = [Row(key="1", value=v, topic="t", partition=0, offset=i,
                timestamp=dt.datetime(2024, 1, 1)) for i, v in enumerate(values)]
    schema = "key string, value string, topic string, partition int, offset long, timestamp timestamp"
    return C.bronze_project(spark.createDataFrame(rows, schema))


def _event(**over):
    e = {"event_id": 1, "event_type": "review", "timestamp": "2024-01-01T16:44:00+00:00",
         "app_id": 10, "app_name": "A", "review_text": "good", "review_score": 1,
         "review_votes": 0, "sentiment": "positive"}
    e.update(over)
    return json.dumps(e)


def test_json_edge(spark):
    missing_sent = json.loads(_event())
    del missing_sent["sentiment"]
    values = [
        _event(),                                   # valid
        _event(event_id=2, app_id=3_000_000_000),   # int overflow
        _event(event_id=3, review_score="7"),       # string for an int
        _event(event_id=4, review_votes=1.5),       # float for an int
        _event(event_id=5)[:-10],                   # truncated object
        "not json at all",
        None,
        _event(event_id=8, extra_field=1),          # extra field
        json.dumps(missing_sent),                   # missing sentiment
    ]
    tagged = C.tag_events(_bronze(spark, values)).collect()
    reasons = [r.reject_reason for r in tagged]
    assert reasons[0] is None
    assert reasons[1] == "missing_app_id"
    assert reasons[2] == "missing_review_score"
    assert reasons[3] is None and tagged[3].review_votes is None  # votes may be null in silver
    assert reasons[4] == "missing_event_id" and tagged[4]._corrupt_record is not None
    assert reasons[5] == "missing_event_id"
    assert reasons[6] == "missing_event_id"
    assert reasons[7] is None
    assert reasons[8] == "invalid_sentiment"
    silver = C.bronze_to_silver(_bronze(spark, values))
    assert silver.columns == SILVER_COLUMNS
    assert silver.count() == 3


def test_time_edge(spark):
    vals = ["2024-01-01T16:44:00.123456+00:00", "2024-01-01T16:44:00+00:00",
            "2024-01-01T16:44:00+03:00", "garbage", None, "2024-01-01T16:59:59.999999+00:00"]
    df = spark.createDataFrame([(v,) for v in vals], "timestamp string")
    out = [r.event_time for r in C.parse_event_time(df).collect()]
    assert out[0] == dt.datetime(2024, 1, 1, 16, 44, 0, 123456)
    assert out[1] == dt.datetime(2024, 1, 1, 16, 44)
    assert out[2] == dt.datetime(2024, 1, 1, 13, 44)
    assert out[3] is None and out[4] is None
    trend = P.hourly_trend(C.parse_event_time(df).where(F.col("event_time").isNotNull())).collect()
    assert [(r.hour.hour, r["count"]) for r in trend] == [(13, 1), (16, 3)]


def test_sentiment_edge(spark):
    vals = ["Positive ", " NEGATIVE", "neutral", "", None]
    bronze = _bronze(spark, [_event(event_id=i + 1, sentiment=v) for i, v in enumerate(vals)])
    tagged = C.tag_events(bronze).orderBy("event_id").collect()
    assert [r.sentiment for r in tagged[:2]] == ["positive", "negative"]
    assert [r.reject_reason for r in tagged] == [None, None] + ["invalid_sentiment"] * 3


def test_token_edge(spark):
    texts = ["A  good\tGAME \n 10/10  ", "", "the and of", "fun \U0001F600 game"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "event_id long, review_text string")
    ours = X.tokenize(df, parity=True).orderBy("event_id").collect()
    mllib = Tokenizer(inputCol="review_text", outputCol="words").transform(df).orderBy("event_id").collect()
    assert [r.words for r in ours] == [r.words for r in mllib]
    clean = X.tokenize(df).orderBy("event_id").collect()
    assert clean[0].words == ["a", "good", "game", "10/10"]
    assert clean[1].words == []
    stop = X.remove_stopwords(X.tokenize(df)).orderBy("event_id").collect()
    assert stop[2].filtered_words == []
    assert P.text_length(df).orderBy("event_id").collect()[3].review_text_length == 10
    nulls = spark.createDataFrame([(1, None)], "event_id long, review_text string")
    assert X.tokenize(nulls).first().words is None


def test_ties(spark):
    rows = [(a, f"app{a}", "positive", 1) for a in range(25) for _ in range(2 if a < 22 else 1)]
    df = spark.createDataFrame(rows, "app_id int, app_name string, sentiment string, review_votes int")
    top = P.top_apps(df, 20).collect()
    assert [r.app_id for r in top] == list(range(20))  # equal counts -> by app id
    docs = spark.createDataFrame([(1, "yy xx zz"), (2, "zz xx yy")], "event_id long, review_text string")
    v = X.vocabulary(X.term_frequencies(X.terms(docs)), vocab_size=2, min_df=1).orderBy("rank").collect()
    assert [r.term for r in v] == ["xx", "yy"]
    sc = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9)], "label int, score double")
    pts = V.roc_points(sc, with_origin=False).collect()
    assert [(r.score, r.pos, r.neg, r.tp, r.fp) for r in pts] == [(0.9, 1, 0, 1, 0), (0.5, 1, 1, 2, 1)]


def test_confusion_gap(spark):
    df = spark.createDataFrame([("positive", "positive"), ("negative", "negative"),
                                ("positive", "positive")], "label_text string, prediction_text string")
    cm = {(r.label_text, r.prediction_text): r["count"] for r in V.confusion_matrix(df).collect()}
    assert cm == {("negative", "negative"): 1, ("negative", "positive"): 0,
                  ("positive", "negative"): 0, ("positive", "positive"): 2}
    never = spark.createDataFrame([("positive", "negative"), ("negative", "negative")],
                                  "label_text string, prediction_text string")
    m = V.confusion_metrics(never).first()
    assert m.precision == 0.0 and m.recall == 0.0 and m.f1 == 0.0 and m.specificity == 1.0
    empty = spark.createDataFrame([], "label_text string, prediction_text string")
    assert [r["count"] for r in V.confusion_matrix(empty).collect()] == [0, 0, 0, 0]


def test_auc_degenerate(spark):
    def auc(rows):
        df = spark.createDataFrame(rows, "label int, score double")
        return V.auc(df).first().area_under_roc
    assert auc([(1, 0.1), (1, 0.9)]) is None
    assert auc([(1, 0.5), (0, 0.5), (1, 0.5), (0, 0.5)]) == 0.5
    assert auc([(1, 0.9), (1, 0.8), (0, 0.2), (0, 0.1)]) == 1.0
    assert auc([(0, 0.9), (0, 0.8), (1, 0.2), (1, 0.1)]) == 0.0


def test_stream_restart(spark, tmpdir_fresh):
    src, out = f"{tmpdir_fresh}/topic", f"{tmpdir_fresh}/lake"
    rec = "key string, value string, topic string, partition int, offset long, timestamp timestamp"
    first = [("1", _event(event_id=i), "t", 0, i, dt.datetime(2024, 1, 1)) for i in range(5)]
    spark.createDataFrame(first, rec).write.json(f"{src}/a")

    def run():
        stream_to_bronze(stream_source(spark, f"{src}/*", fmt="json"), f"{out}/bronze", f"{out}/ckpt")
        return spark.read.parquet(f"{out}/bronze")

    assert run().count() == 5
    second = [("1", _event(event_id=i), "t", 0, i, dt.datetime(2024, 1, 1)) for i in range(5, 8)]
    spark.createDataFrame(second, rec).write.json(f"{src}/b")
    assert run().count() == 8
    b = run()  # nothing new
    assert b.count() == 8 and b.select("offset").distinct().count() == 8


def test_blank_strings_follow_python_whitespace(spark):
    rows = [(1, "text"), (2, ""), (3, " \t\n "), (4, None)]
    df = spark.createDataFrame(rows, "event_id long, review_text string")
    rep = {r.column: (r.null_count, r.blank_count) for r in P.missing_report(df).collect()}
    assert rep["review_text"] == (1, 2)
    assert rep["event_id"] == (0, 0)


def test_stream_restart_after_partial_run(spark, tmpdir_fresh):
    import time
    from reviewlake.operators.clean import bronze_project
    src, out = f"{tmpdir_fresh}/topic", f"{tmpdir_fresh}/lake"
    rec = "key string, value string, topic string, partition int, offset long, timestamp timestamp"
    for part in range(3):  # three record files
        rows = [("1", _event(event_id=part * 10 + i), "t", 0, part * 10 + i, dt.datetime(2024, 1, 1))
                for i in range(4)]
        spark.createDataFrame(rows, rec).coalesce(1).write.json(f"{src}/p{part}")
    source = stream_source(spark, f"{src}/*", fmt="json", max_files_per_trigger=1)
    # a first run stopped after its first micro-batch (one file) is committed
    q = (bronze_project(source).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", f"{out}/ckpt").trigger(processingTime="60 seconds")
         .start(f"{out}/bronze"))
    deadline = time.time() + 120
    while not q.recentProgress and time.time() < deadline:
        time.sleep(0.5)
    q.stop()
    partial = spark.read.parquet(f"{out}/bronze").count()
    assert 0 < partial < 12
    # the restart drains the rest; nothing is written twice
    stream_to_bronze(stream_source(spark, f"{src}/*", fmt="json", max_files_per_trigger=1),
                     f"{out}/bronze", f"{out}/ckpt")
    b = spark.read.parquet(f"{out}/bronze")
    assert b.count() == 12 and b.select("offset").distinct().count() == 12


@pytest.mark.parametrize("kind", ["bigint", "int", "string"])
def test_rows_that_may_match_hold_every_match(spark, monkeypatch, kind):
    from reviewlake.sources import tables as T
    df = spark.range(-2000, 6000).selectExpr(f"cast(id as {kind}) AS k", "id AS n").unionByName(
        spark.createDataFrame([(None, 9000), ("7", 9001)], "k string, n long").selectExpr(f"cast(k as {kind}) AS k", "n"))
    ids = df.where("n % 10 = 0 OR n = 9000").select("k")
    wide = T.may_match(df, ids.unionAll(ids), "k")
    monkeypatch.setattr(T, "ROW_BITS", 1024)
    monkeypatch.setattr(T, "MOST_BITS", 1024)
    narrow = T.may_match(df, ids, "k")
    for d in (wide, narrow):
        assert d.columns == df.columns and d.join(ids, "k").exceptAll(df.join(ids, "k")).count() == 0
        assert d.join(ids, "k").count() == df.join(ids, "k").count() >= 800
    assert 800 <= wide.count() < 1600 < narrow.count() < 8002        # a bitmap too small lets more through
    assert T.may_match(df, ids.limit(0), "k").count() == 0
    other = ids.selectExpr("cast(k as double) AS k")
    assert T.may_match(df, other, "k").count() == 8002
