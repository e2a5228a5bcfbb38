"""Exact dedup by progressive refinement: length, prefix hash, full hash.

The corpus text is never shuffled. A first scan reduces every row to (length,
prefix hash); lengths that occur once drop out, then prefixes that occur once
within a length. Only the rows of the groups that survive both have their full
content hashed, in a second scan; they alone are grouped by the full hash.

Survivors reach the second scan as buckets of (length, prefix) - at most
``2**bucket_bits`` of them whatever the data, so they may be broadcast. A
bucket shared by chance only costs a hash, since groups are made from length,
prefix and full hash of the rows themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import WS, add_row_key, fresh, one_each, shared_path, text_or_empty, totals

BUCKET_BITS = 18


def normalised(col: str):
    # never null, and known to be: else the joins below filter on it by computing it again
    return F.coalesce(F.regexp_replace(text_or_empty(col), WS, " "), F.lit(""))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                prefix_chars: int = 256, bucket_bits: int = BUCKET_BITS,
                digest_all: bool = False) -> DataFrame:
    """``docs`` without the text, plus keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of white space became one
    space; null counts as empty. The smallest id of a group stays. Every input
    row is returned: rows that repeat an id and text each count in group_size
    and share ``kept``; a null id is larger than any other, and a group of
    null ids only keeps all its rows (keep_id null). ``text_sha256`` is null
    where length or prefix alone told the row apart, unless ``digest_all``.
    Other columns pass through; those named like a new one are replaced.
    """
    length, prefix, bucket, norm, hit, digest, low, size = fresh(
        docs, "length", "prefix", "bucket", "norm", "hit", "digest", "low", "size")
    new = ["keep_id", "group_size", "kept", "text_sha256"]
    other = [c for c in docs.columns if c.lower() not in [*new, id_col.lower(), text_col.lower()]]
    rows = docs.withColumn(norm, normalised(text_col)).withColumns({
        length: F.coalesce(F.length(norm), F.lit(0)), prefix: F.xxhash64(F.substring(norm, 1, prefix_chars))})
    rows = rows.withColumn(
        bucket, F.coalesce(F.pmod(F.xxhash64(length, prefix), F.lit(1 << bucket_bits)).cast("int"), F.lit(0)))

    # 1 and 2: counts by (length, prefix), summed up to lengths; both combine map-side
    by_prefix = rows.groupBy(length, prefix, bucket).agg(F.count(F.lit(1)).alias(size))
    lengths = by_prefix.groupBy(length).agg(F.sum(size).alias(low)).where(F.col(low) > 1)
    alive = by_prefix.where(F.col(size) > 1).join(lengths, length, "left_semi")
    buckets = alive.select(bucket).distinct().withColumn(hit, F.lit(True))

    # 3: the full content of what survives
    rows = rows.join(F.broadcast(buckets), bucket, "left")
    full = F.coalesce(F.sha2(norm, 256), F.lit(""))
    wanted = F.col(hit) if not digest_all else F.lit(True)
    rows = rows.select(
        F.col(f"`{id_col}`"), *[F.col(f"`{c}`") for c in other], length, prefix, hit,
        F.when(wanted, full).alias(digest))
    groups = (rows.where(F.col(hit)).groupBy(length, prefix, digest)
              .agg(F.min(F.col(f"`{id_col}`")).alias(low), F.count(F.lit(1)).alias(size))
              .where(F.col(size) > 1).select(F.col(digest), low, size))
    # rows without a digest match nothing: their keys are spread, not one null
    spread = F.coalesce(F.col(digest), F.concat(F.lit("-"), F.col(prefix).cast("string")))
    groups = groups.withColumnRenamed(digest, norm)
    rows = rows.join(groups, spread == F.col(norm), "left")
    keep = F.when(F.col(size).isNull(), F.col(f"`{id_col}`")).otherwise(F.col(low))
    return rows.select(
        F.col(f"`{id_col}`"), *[F.col(f"`{c}`") for c in other],
        keep.alias("keep_id"), F.coalesce(F.col(size), F.lit(1)).cast("long").alias("group_size"),
        F.col(f"`{id_col}`").eqNullSafe(keep).alias("kept"), F.col(digest).alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts: that of the smallest id.

    Of rows of that id with texts that differ in white space one stays, and of
    rows that repeat id and text any one. A group of null ids keeps one row too.
    """
    key, crc, best = fresh(docs, "key", "crc", "best")
    keyed = add_row_key(docs, id_col, text_col, key, crc)
    marks = exact_dedup(keyed.select(key, crc, id_col, text_col), id_col, text_col)
    path = shared_path(docs.sparkSession, "copies")
    marks.where(F.col("group_size") > 1).select(key, crc, "kept", "text_sha256").write.parquet(path)
    copies = docs.sparkSession.read.parquet(path)
    row = F.struct(key, crc)
    stays = totals(copies.where("kept"), "text_sha256", **{best: F.min(row)})
    gone = copies.join(stays, "text_sha256").where(row != F.col(best)).select(key, crc)
    left = keyed.join(gone, [key, crc], "left_anti")
    return one_each(left, copies.select(key, crc), key, crc).select(*docs.columns)
