"""Table sinks: versioned silver snapshots, reports, exported predictions."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.operators.sampling import partition_by_key
from reviewlake.schemas import SILVER_COLUMNS


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _versions(spark: SparkSession, root: str, committed: bool = True) -> list[int]:
    fs, p, jvm = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if not (st.isDirectory() and name.startswith("v=")):
            continue
        if not committed or fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")) or any(
                fs.exists(jvm.org.apache.hadoop.fs.Path(c.getPath(), "_SUCCESS"))
                for c in fs.listStatus(st.getPath()) if c.isDirectory()):
            out.append(int(name[2:]))
    return out


def latest_snapshot(spark: SparkSession, root: str) -> str:
    """Newest committed version directory (``v=<n>`` holding ``_SUCCESS``) under ``root``.

    A plain directory without versions is returned as is; one whose versions
    are all unfinished has nothing to read and raises. Readers never glob
    data files, so files of superseded versions are never read.
    """
    versions = _versions(spark, root)
    if not versions and _versions(spark, root, committed=False):
        raise FileNotFoundError(f"{root} has no committed version yet")
    return f"{root.rstrip('/')}/v={max(versions)}" if versions else root


def write_silver(tagged: DataFrame, root: str, fmt: str = "parquet",
                 partitions: int | None = None, key: str = "app_id") -> str:
    """Overwrite silver: valid rows to ``status=valid``, rejects to ``status=rejected``.

    One job writes both (``partitionBy("status")``), so the parse runs once.
    ``fmt="delta"`` overwrites a Delta table; for parquet each call writes a
    new ``v=<millis>`` version and readers take the newest committed one.
    Rows are clustered by app (``partitions`` = fixed count, else AQE
    rebalancing, which also splits a hot app into several files).
    """
    cols = SILVER_COLUMNS + ["reject_reason", "raw_json"]
    out = tagged.select(*cols, F.when(F.col("reject_reason").isNull(), "valid")
                        .otherwise("rejected").alias("status"))
    out = partition_by_key(out, partitions, key)
    if fmt == "delta":
        out.write.format("delta").mode("overwrite").partitionBy("status").save(root)
        return root
    spark = tagged.sparkSession
    version = max([int(time.time() * 1000)] + [v + 1 for v in _versions(spark, root, False)])
    target = f"{root.rstrip('/')}/v={version}"
    out.write.mode("errorifexists").partitionBy("status").format(fmt).save(target)
    return target


def read_silver(spark: SparkSession, root: str, fmt: str = "parquet",
                status: str = "valid") -> DataFrame:
    """Silver rows of one status from the newest snapshot (partition-pruned)."""
    path = root if fmt == "delta" else latest_snapshot(spark, root)
    df = spark.read.format(fmt).load(path).where(F.col("status") == status)
    if status == "valid":
        return df.select(*SILVER_COLUMNS)
    return df.drop("status")


def write_report(df: DataFrame, path: str, single_file: bool = True) -> None:
    """Small result to CSV with a header; ``single_file`` gathers the finished rows in one part.

    The rows are shuffled to that part, so the work before it keeps its tasks.
    """
    out = df.repartition(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def export_predictions(pred: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Distributed write of scored rows; the count is read back from the written table."""
    from reviewlake.operators.clean import probability_columns
    cols = ["event_id", "review_text", "label_text", "prediction_text",
            "probability_negative", "probability_positive"]
    out = probability_columns(pred).select(*cols)
    out.write.mode("overwrite").format(fmt).option("header", True).save(path)
    spark = pred.sparkSession
    return spark.read.format(fmt).option("header", True).load(path).count()
