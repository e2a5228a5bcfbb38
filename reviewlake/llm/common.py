"""Helpers shared by the operators: the word class, row keys, the shared folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.session import ensure_checkpoint_dir

# Fixed value: the white space of every operator, space and U+0009..U+000D.
WS = r"[\x20\x09-\x0D]+"


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` doesn't have yet (compared without case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        new = f"__{name}"
        while new in taken:
            new += "_"
        taken.add(new)
        out.append(new)
    return out


def text_or_empty(col: str) -> Column:
    """The text column as a string, null as the empty string."""
    return F.coalesce(F.col(f"`{col}`").cast("string"), F.lit(""))


def add_row_key(df: DataFrame, id_col: str, text_col: str, key: str, crc: str) -> DataFrame:
    """Add (key, crc): a never-null join key of a row.

    ``key`` is the id itself where it is an integer, else a hash of id and
    text; ``crc`` tells rows apart that share an id but not the text. Rows
    that repeat id and text share the key, and so every decision.
    """
    text = text_or_empty(text_col)
    kind = df.schema[id_col].dataType
    hashed = F.xxhash64(F.col(f"`{id_col}`"), text)
    whole = isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    value = F.coalesce(F.col(f"`{id_col}`").cast("long"), hashed) if whole else hashed
    return df.withColumns({key: value, crc: F.crc32(text)})


def set_aside(df: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns of these names renamed, and how to rename them back."""
    clash = [c for c in df.columns if c.lower() in names]
    new = dict(zip(clash, fresh(df, *clash)))
    return df.withColumnsRenamed(new), {v: k for k, v in new.items()}


def totals(df: DataFrame, *keys: str, **aggs: Column) -> DataFrame:
    """Aggregates by ``keys`` for a join back to the rows of ``df``.

    Grouped by one struct of the keys, the result isn't partitioned by the
    keys themselves, so the join deals both sides anew - and only then can the
    engine split a key that has very many rows over several tasks.
    """
    grouped = df.groupBy(F.struct(*keys).alias("k")).agg(*[a.alias(name) for name, a in aggs.items()])
    return grouped.select("k.*", *aggs)


def one_each(df: DataFrame, keys: DataFrame, *names: str) -> DataFrame:
    """``df`` with one row of each that repeats the key columns ``names``; of repeats any one stays.

    ``keys`` has the same key columns, read cheaply. Rows are only gathered by
    key where some repeat, and then those alone: partial aggregation leaves at
    most one row a task of a key that very many rows repeat.
    """
    repeats = totals(keys, *names, n=F.count(F.lit(1))).where("n > 1").select(*names)
    if repeats.isEmpty():
        return df
    one = df.join(repeats, list(names), "left_semi").dropDuplicates(list(names))
    return df.join(repeats, list(names), "left_anti").unionByName(one)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the checkpoint folder that the cluster shares."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder, and this library's folder on the Python workers' path.

    The folder only matters where executors see it and the library isn't
    installed there, as in local mode started from another folder.
    """
    ensure_checkpoint_dir(spark)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
