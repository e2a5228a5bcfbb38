"""Repeatable sampling and splitting (section 2.9) and the split-safety joins (2.4).

Every draw is a function of ``md5(key)``, so the same rows come back whatever
the file layout, partition count or executor count (``limit`` and
``randomSplit`` do not have that property).

``hash_top_n`` is the exact engine behind all "first n rows per group in hash
order" samples. Ranking a whole group with a window would put the group in
one task, and one group may hold a third of the data. Instead:

1. count rows per group, on the group columns; groups of up to ``n`` rows are
   taken whole, the others get as many leading hex digits of the hash as cut
   them into cells of about a million rows;
2. count rows per (group, cell), partially aggregated on the map side; a
   running sum over a group's cells finds the one in which its n-th row lies;
3. only that cell's keys are ranked: its row at the right place is the cut-off;
4. one pass over the full rows keeps those up to their group's cut-off.

Steps 1 to 3 read group and key only; the full rows, texts and all, are read
once and not shuffled while the groups are few enough to broadcast (counted).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.functions.exprs import hash_fraction_hex, hex_hash
from reviewlake.session import ensure_checkpoint_dir

_H = "__h"
MAX_BROADCAST_GROUPS = 100_000


def _join_groups(left: DataFrame, right: DataFrame, g: list[str], how: str) -> DataFrame:
    """Join on the group columns null-safely (a null group is a group too)."""
    r = right.select(*[F.col(c).alias(f"__rg_{c}") for c in g],
                     *[c for c in right.columns if c not in g])
    cond = [left[c].eqNullSafe(r[f"__rg_{c}"]) for c in g]
    return left.join(r, cond, how).drop(*[f"__rg_{c}" for c in g])


def hash_top_n(df: DataFrame, n: int, key: list[str] | tuple[str, ...],
               group: list[str] | tuple[str, ...] = (), salt: str = "",
               cell_rows: int = 1_000_000) -> DataFrame:
    """Exactly the first ``n`` rows of each group ordered by (md5(key), key).

    Keys should be unique within a group (rows that share the last key are
    taken together). Groups of up to ``n`` rows are returned whole. Building
    the plan counts the groups once - a scan of group columns only - and
    checkpoints the larger ones; their number decides between broadcasting
    per-group rows and shuffled joins with the same result.
    """
    key, group = list(key), list(group)
    g = group or ["__g"]
    base = df if group else df.withColumn("__g", F.lit(0))
    d = base.withColumn(_H, hex_hash(*key, salt=salt))
    narrow = d.select(*dict.fromkeys([*g, _H, *key]))

    # leading hex digits that cut a group's hash space into cells of about cell_rows
    digits = F.greatest(F.lit(0), F.ceil(F.log(16.0, F.col("__cnt") / F.lit(float(cell_rows)))))
    widths = (base.groupBy(*g).agg(F.count(F.lit(1)).alias("__cnt")).where(F.col("__cnt") > n)
              .select(*g, digits.cast("int").alias("__k")))
    ensure_checkpoint_dir(df.sparkSession)
    widths = widths.checkpoint(eager=True)
    few = widths.count() <= MAX_BROADCAST_GROUPS
    small = F.broadcast if few else (lambda x: x)

    celled = _join_groups(narrow, small(widths), g, "inner").withColumn(
        "__cell", F.col(_H).substr(F.lit(1), F.col("__k")))
    upto = Window.partitionBy(*g).orderBy("__cell").rowsBetween(Window.unboundedPreceding, 0)
    cells = (celled.groupBy(*g, "__cell").agg(F.count(F.lit(1)).alias("__c"))
             .withColumn("__cum", F.sum("__c").over(upto))
             .where((F.col("__cum") >= n) & (F.col("__cum") - F.col("__c") < n))
             .select(*g, F.col("__cell").alias("__last"), (F.lit(n) - F.col("__cum") + F.col("__c")).alias("__need")))
    order = Window.partitionBy(*g).orderBy(_H, *key)
    cut = (_join_groups(celled, small(cells), g, "inner").where(F.col("__cell") == F.col("__last"))
           .withColumn("__rn", F.row_number().over(order)).where(F.col("__rn") == F.col("__need"))
           .select(*g, F.struct(_H, *key).alias("__cut")))
    return (_join_groups(d, small(cut), g, "left")
            .where(F.col("__cut").isNull() | (F.struct(_H, *key) <= F.col("__cut")))
            .select(*df.columns))


def balanced_sample(df: DataFrame, n_per_class: int, key: str = "event_id",
                    label_col: str = "label_text", salt: str = "",
                    exact: bool = True) -> DataFrame:
    """``n_per_class`` rows of every class, chosen by hash order of ``key``.

    ``exact=False`` is the one-pass form: keep rows whose hash falls below
    ``n_per_class / class_count`` of the hash space (about ``n_per_class`` rows,
    no ranking at all).
    """
    if exact:
        return hash_top_n(df, n_per_class, [key], [label_col], salt)
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("__cnt"))
    frac = F.least(F.lit(1.0), F.lit(float(n_per_class)) / F.col("__cnt"))
    thr = F.lower(F.lpad(F.hex(F.floor(frac * F.lit(float(1 << 32))).cast("long")), 8, "0"))
    return (_join_groups(df, counts, [label_col], "inner")
            .where((frac >= 1.0) | (F.substring(hex_hash(key, salt=salt), 1, 8) < thr))
            .drop("__cnt"))


def hash_split(df: DataFrame, key: str = "event_id", train_fraction: float = 0.8,
               salt: str = "", out_col: str = "split") -> DataFrame:
    """Adds ``split`` = 'train' | 'test' from ``md5(key)``: repeatable, no shuffle.

    With ``key="review_text"`` exact copies of a text land on the same side.
    """
    thr = hash_fraction_hex(train_fraction)
    return df.withColumn(out_col, F.when(hex_hash(key, salt=salt) < F.lit(thr), "train")
                         .otherwise("test"))


def train_part(split: DataFrame, col: str = "split") -> DataFrame:
    return split.where(F.col(col) == "train").drop(col)


def test_part(split: DataFrame, col: str = "split") -> DataFrame:
    return split.where(F.col(col) == "test").drop(col)


def per_group_sample(df: DataFrame, n: int, group: str = "app_id", key: str = "event_id",
                     salt: str = "") -> DataFrame:
    """At most ``n`` rows per group, first in hash order (exact, skew-safe)."""
    return hash_top_n(df, n, [key], [group], salt)


def sample_n(df: DataFrame, n: int, key: str = "event_id", salt: str = "") -> DataFrame:
    """Exactly ``min(n, count)`` rows, first in hash order."""
    return hash_top_n(df, n, [key], [], salt)


def _digest(df: DataFrame, key: str):
    """What stands for the key in a join: itself, or 32 bytes for a text."""
    wide = df.schema[key].dataType.simpleString() in ("string", "binary")
    return F.unhex(F.sha2(F.col(key), 256)) if wide else F.col(key)


def _trained(train: DataFrame, key: str) -> DataFrame:
    return train.where(F.col(key).isNotNull()).select(_digest(train, key).alias("__kd")).distinct()


def leakage_check(train: DataFrame, test: DataFrame, key: str = "event_id") -> DataFrame:
    """Test rows whose ``key`` also occurs in train (left semi join); expected empty.

    Texts meet as SHA-256 digests, distinct on the train side (combined on the
    map side), so a text that very many rows share is one row there; on the
    test side AQE splits it.
    """
    return test.withColumn("__kd", _digest(test, key)).join(_trained(train, key), "__kd", "left_semi").drop("__kd")


def exclude_training(scored: DataFrame, train: DataFrame, key: str = "event_id") -> DataFrame:
    """Rows of ``scored`` whose ``key`` is not in the training set (left anti join, by digest)."""
    return scored.withColumn("__kd", _digest(scored, key)).join(_trained(train, key), "__kd", "left_anti").drop("__kd")


def partition_by_key(df: DataFrame, n: int | None = None, key: str = "app_id") -> DataFrame:
    """Cluster rows by ``key`` before a write.

    With ``n`` this is ``repartition(n, key)`` (reference parity); without it
    a REBALANCE hint lets AQE pick the count and split a hot key's partition.
    """
    if n:
        return df.repartition(n, key)
    return df.hint("rebalance", key)
