"""The corpus pipeline: language ID, exact dedup, near-dedup, mixing, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a frame with the columns of ``documents`` - but for the last, which
returns the packed pieces. ``run`` applies them to the whole table, each
stage's result written to the shared folder and read again by the next.

No stage needs another's side results: each judges the rows it is given. An
empty table stays empty through all of them; a null text has no language and
goes with the first stage. Columns beyond those of ``documents`` pass through
until packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm import exact_dedup, language_id, mixing, near_dedup, packing
from reviewlake.llm.common import documents, prepare, set_aside, shared_path
from reviewlake.llm.queries import ORACLE as _ORACLE
from reviewlake.llm.queries import QUERIES as _QUERIES


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language: those without a letter go.

    ``lang`` becomes the predicted language, by a network fitted on a bounded
    sample of the documents' own labels. Where no text is labelled there is
    nothing to learn: documents with a letter stay and keep their ``lang``.
    """
    prepare(spark)
    # the prediction must not replace columns of the table that have its names
    rows, back = set_aside(docs, "lang_pred", "score")
    model = language_id.train(docs)
    if model is None:
        return docs.where(F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(r"\p{L}"))
    kept = language_id.identify(rows, model).where(F.col("lang_pred") != language_id.UNDETERMINED)
    return kept.withColumn("lang", F.col("lang_pred")).select(*rows.columns).withColumnsRenamed(back)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, repeated rows and null ids included."""
    prepare(spark)
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    prepare(spark)
    return near_dedup.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents, source shares by the square root of their counts."""
    prepare(spark)
    rows, back = set_aside(docs, "copy", "n_copies")
    return mixing.mix(rows).select(*rows.columns).withColumnsRenamed(back)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 1024 tokens."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mixing", mixed),
    ("packing", packed),
]

ORACLE_SQL = None  # language ID is a trained network; tests compare the stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"pipeline-{name}")
        made = stage(spark, docs, sf_dir)
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {**_QUERIES, "pipeline": run}
ORACLE = dict(_ORACLE) | ({"pipeline": ORACLE_SQL} if ORACLE_SQL else {})
