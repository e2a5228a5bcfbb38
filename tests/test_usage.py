"""The README's end-to-end example runs as written (on a CSV made from the test tables)."""

from reviewlake.operators import clean as C
from reviewlake.operators import models as M
from reviewlake.operators import profile as P
from reviewlake.operators import sampling as S
from reviewlake.sinks import publish_events, write_report, write_silver
from reviewlake.sources import scan_reviews_csv, scan_table
from reviewlake.sources.tables import reviews
from reviewlake.streaming import stream_source, stream_to_bronze
from tests.conftest import SF_SMALL


def test_readme_pipeline(spark, tmpdir_fresh):
    root = tmpdir_fresh
    (reviews(spark, SF_SMALL)
     .selectExpr("CAST(app_id AS STRING) app_id", "app_name", "review_text",
                 "CAST(review_score AS STRING) review_score",
                 "CAST(review_votes AS STRING) review_votes")
     .write.option("header", True).option("escape", '"').csv(f"{root}/reviews.csv"))

    events = C.build_event(C.seq_id(scan_reviews_csv(spark, f"{root}/reviews.csv")))
    publish_events(events.where("reject_reason IS NULL").drop("reject_reason"), f"{root}/topic", batch_id="reviews.csv")
    stream_to_bronze(stream_source(spark, f"{root}/topic"), f"{root}/bronze", f"{root}/_ckpt")
    write_silver(C.tag_events(spark.read.parquet(f"{root}/bronze")), f"{root}/silver")
    silver = scan_table(spark, f"{root}/silver").where("status = 'valid'")
    write_report(P.profile(silver), f"{root}/reports/profile")
    write_report(P.top_apps(silver, 20), f"{root}/reports/top_apps")
    split = S.hash_split(C.model_frame(silver))
    train = S.balanced_sample(S.train_part(split), 25000)
    done = M.compare_models(train, S.test_part(split), f"{root}/models", kinds=("nb", "lr"))
    write_report(done.metrics(), f"{root}/reports/model_comparison")

    n = reviews(spark, SF_SMALL).count()
    assert silver.count() == n
    prof = {r.metric: float(r.value) for r in
            spark.read.option("header", True).csv(f"{root}/reports/profile").collect()}
    assert prof["total_rows"] == n
    assert spark.read.option("header", True).csv(f"{root}/reports/model_comparison").count() == 2
