"""Batch sources: parquet/delta tables and the two views over the test tables.

Reads are plain ``spark.read`` calls so Catalyst can prune columns and push
filters into the scan; views are DataFrame expressions, never materialised.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.functions.exprs import strip_py

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Bits of a bitmap of ids: for each id, at most in all (16 MB), and in a row of it.
ID_BITS, MOST_BITS, ROW_BITS = 16, 1 << 27, 1 << 15


def may_match(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``df`` without most rows whose ``key`` isn't in ``ids``; no row that has its match is dropped.

    For a join that would shuffle wide rows of which many find nothing. The
    ids' hashes set the bits of a bitmap, 16 times as many as there are ids
    (counted when this is called), so about one row in 16 passes unmatched;
    beyond 2^27 bits, where a larger broadcast would be needed, more do. Keys
    of other than equal, whole or text types are left alone: they can be equal
    without an equal hash.
    """
    if df.schema[key].dataType != ids.schema[key].dataType or ids.schema[key].dataType.simpleString() not in ("bigint", "int", "string"):
        return df
    n = ids.count()
    bits = min(MOST_BITS, max(ROW_BITS, 1 << math.ceil(math.log2(ID_BITS * max(n, 1)))))
    at = F.pmod(F.xxhash64(key), F.lit(bits))
    row, bit = F.floor(at / ROW_BITS).cast("int"), F.pmod(at, F.lit(ROW_BITS))
    # dealt by the bitmap's rows, so that ids are shuffled, not bitmaps
    maps = (ids.where(F.col(key).isNotNull()).select(row.alias("__row"), bit.alias("__bit")).repartition("__row")
            .groupBy("__row").agg(F.bitmap_construct_agg("__bit").alias("__bits")))
    byte = F.conv(F.hex(F.expr("substring(__bits, CAST(__bit DIV 8 + 1 AS INT), 1)")), 16, 10).cast("int")
    hit = F.expr("CAST(power(2, __bit % 8) AS INT)")
    return (df.withColumns({"__row": row, "__bit": bit}).join(F.broadcast(maps), "__row")
            .where(byte.bitwiseAND(hit) != 0).select(*df.columns))


def reviews(spark: SparkSession, sf_dir: str, text: str = "text", prefilter: bool = False) -> DataFrame:
    """Silver-shaped review events over ``documents`` joined with ``labels``.

    Inner equi-join on ``doc_id``; the strategy (broadcast when ``labels`` is
    small by runtime statistics, else sort-merge) is left to AQE. Unused
    columns are pruned out of the scan by Catalyst.

    ``text="length"`` replaces ``review_text`` by ``review_text_length``
    computed on the documents side *before* the join: length-only reports
    then shuffle an int per row instead of the whole text (Catalyst prunes
    columns through a join but does not push expressions below it).
    ``text="flags"`` adds ``review_text_blank`` in the same way.
    ``prefilter=True`` drops most documents without a label before the join, by
    ``may_match``: for queries that join whole texts of large tables.
    """
    d = table(spark, sf_dir, "documents")
    if prefilter:
        d = may_match(d, table(spark, sf_dir, "labels").select("doc_id"), "doc_id")
    if text in ("length", "flags"):
        made = {"review_text_length": F.length("text"), "review_text_blank": strip_py("text") == ""}
        names = list(made)[:1 if text == "length" else 2]
        d = d.select("doc_id", "source", *[made[n].alias(n) for n in names])
        text_cols = [F.col(f"d.{n}") for n in names]
    else:
        text_cols = [F.col("d.text").alias("review_text")]
    d = d.alias("d")
    lab = table(spark, sf_dir, "labels").alias("l")
    positive = F.col("l.quality") == 1
    return (
        d.join(lab, F.col("d.doc_id") == F.col("l.doc_id"), "inner")
        .select(
            F.col("d.doc_id").alias("event_id"),
            F.lit("review").alias("event_type"),
            F.expr("substring(d.source, 4)").cast("int").alias("app_id"),
            F.col("d.source").alias("app_name"),
            *text_cols,
            F.when(positive, 1).otherwise(-1).alias("review_score"),
            F.col("l.toxic").alias("review_votes"),
            F.when(positive, "positive").otherwise("negative").alias("sentiment"),
        )
    )


def texts(spark: SparkSession, sf_dir: str, text: str = "text") -> DataFrame:
    """All ``documents`` in the shape of reviews, for what needs no label."""
    length = text == "length"
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("event_id"), F.expr("substring(source, 4)").cast("int").alias("app_id"),
        F.col("source").alias("app_name"),
        F.length("text").alias("review_text_length") if length else F.col("text").alias("review_text"))


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-shaped view over the ``events`` stream table."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").alias("event_time"),
        F.col("user_id").alias("app_id"),
        F.col("event_type").alias("sentiment"),
        F.col("value").alias("review_votes"),
        F.col("props").alias("raw_json"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, label, score): a model-free score for evaluation operators.

    label = ``quality``; score = ``round(n_chars / (n_chars + 1000), 6)``.
    """
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    n = F.col("n_chars").cast("double")
    return d.join(lab, "doc_id", "inner").select(
        F.col("doc_id").alias("event_id"), F.col("quality").alias("label"),
        F.round(n / (n + F.lit(1000.0)), 6).alias("score"))


def scan_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Batch read of a bronze/silver table through its snapshot, never a raw glob.

    ``fmt="delta"`` reads the transaction log when the Delta connector is
    deployed. For ``parquet`` the path is a snapshot root written by
    ``sinks.write_silver``: the newest committed version is read, and a root
    that only has unfinished versions is refused.
    """
    if fmt == "parquet":
        from reviewlake.sinks.tables import latest_snapshot
        path = latest_snapshot(spark, path)
    return spark.read.format(fmt).load(path)


def scan_columns(spark: SparkSession, path: str, columns: list[str],
                 fmt: str = "parquet") -> DataFrame:
    """Column-projected read; ``ReadSchema`` in the scan holds only ``columns``."""
    return scan_table(spark, path, fmt).select(*columns)
