"""Scale probe: skew-sensitive operators on the sf0.1 events, 1x vs 20x, with a hot key.

The 20x set is derived from the events table with Spark (each row repeated
with new ids) and one user is made to hold a third of all rows. Timings show
how run time grows with the data when one group is hot. Writes to a fresh
temporary folder. Usage: python tools/scale_probe.py [sf_dir] [copies]
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from reviewlake.operators import clean as C  # noqa: E402
from reviewlake.operators import evaluate as V  # noqa: E402
from reviewlake.operators import profile as P  # noqa: E402
from reviewlake.operators import sampling as S  # noqa: E402
from reviewlake.session import get_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    spark = get_session("local[8]", conf={"spark.sql.shuffle.partitions": "32",
                                          "spark.ui.showConsoleProgress": "false"})
    out = tempfile.mkdtemp(prefix="reviewlake-scale-")
    base = spark.read.parquet(f"{sf}/events.parquet")
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id"))
    base.withColumn("user_id", hot).write.parquet(f"{out}/x1")
    (base.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"))
     .withColumn("event_id", F.col("event_id") * copies + F.col("copy"))
     .withColumn("user_id", hot).drop("copy").write.parquet(f"{out}/x{copies}"))

    def timed(df) -> float:
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - t0, 2)

    for label in ("x1", f"x{copies}", "x1", f"x{copies}"):  # second round is warm
        ev = spark.read.parquet(f"{out}/{label}").withColumnRenamed("ts", "event_time")
        scored = ev.select((F.col("user_id") == 0).cast("int").alias("label"),
                           (F.col("value") / 1000).alias("score"))
        print(label, ev.count(), {
            "per_group_sample": timed(S.per_group_sample(ev, 100, "user_id", "event_id")),
            "dedup_by_user": timed(C.dedup_events(ev, "user_id")),
            "seq_id": timed(C.seq_id(ev.select("event_id"))),
            "roc_points": timed(V.roc_points(scored)),
            "hourly_trend": timed(P.hourly_trend(ev)),
        })
    spark.stop()


if __name__ == "__main__":
    main()
