"""Best-fit packing by the sum-of-squares rule.

A document is its token ids and an end id. One that is longer than a sequence
is cut into full pieces from its end, so that only its first piece may be
shorter. Full pieces are sequences by themselves; the others are placed, the
largest first, into the open sequence for which the sum over residual gaps of
(number of open sequences with that gap) squared becomes smallest; of equal
sums the smallest gap wins. A new one is opened where none fits.

Pieces are rows of sizes, dealt at random into shards of a fixed expected
number of pieces: shards grow in number, not in size, and each leaves only a
few sequences open.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.llm.common import shared_path
from reviewlake.llm.tokens import encode

LENGTH, END_ID, SHARD_PIECES = 1024, 2, 50_000


def _pieces(id_name: str, length: int, end_id: int, path: str | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, piece, start, size, crc = [], [], [], [], []
            for i, text in enumerate(b.column(1)):
                ids = encode(text.as_py() or "", path)
                raw = memoryview(np.append(ids, end_id).astype("<u4").tobytes())
                n = len(raw) // 4
                cut = [0, *range((n - 1) % length + 1, n + 1, length)]
                for k, (lo, hi) in enumerate(zip(cut[:-1], cut[1:])):
                    row.append(i)
                    piece.append(k)
                    start.append(lo)
                    size.append(hi - lo)
                    crc.append(zlib.crc32(raw[4 * lo:4 * hi]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                 *[pa.array(x, pa.int64()) for x in (start, size, crc)], b.column(2).take(pa.array(row, pa.int64()))],
                names=[id_name, "piece", "start", "length", "ids_crc32", "row"])
    return run


def place(sizes: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each item by the sum-of-squares rule, in the given order."""
    count = np.zeros(length + 1, np.int64)            # open sequences by gap
    open_by_gap: list[list[int]] = [[] for _ in range(length + 1)]
    sequence, offset, made = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), 0
    never = np.iinfo(np.int64).max
    for i, s in enumerate(sizes.tolist()):
        # growth of the sum when a sequence of gap h goes to gap h - s; a filled one counts no more
        grow = np.where(count[s:] > 0, 2 * (count[:length - s + 1] - count[s:]) + 2, never)
        if grow[0] != never:
            grow[0] = 1 - 2 * count[s]
        h = s + int(grow.argmin())
        if grow[h - s] == never:
            h, seq, made = length, made, made + 1
        else:
            seq = open_by_gap[h].pop()
            count[h] -= 1
        if h > s:
            open_by_gap[h - s].append(seq)
            count[h - s] += 1
        sequence[i], offset[i] = seq, length - h
    return sequence, offset


def _place_shard(length: int) -> Callable:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "ids_crc32"], ascending=False, kind="stable")
        sequence, pdf["offset"] = place(pdf["length"].to_numpy(), length)
        pdf["sequence_id"] = -1 - (pdf["shard"].astype("int64") * (1 << 32) + sequence)
        return pdf.drop(columns="shard")
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, length: int = LENGTH,
         end_id: int = END_ID, shard_pieces: int = SHARD_PIECES, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are the end id alone. Rows are packed one by one:
    repeated rows and null ids are documents like others. The result has these
    seven columns only, whatever else ``docs`` has. Pieces are dealt by the
    number of their document's row, so that rows that repeat all else spread too.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string"), F.monotonically_increasing_id())
    cols = [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()),
            *[T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "row")]]
    path = shared_path(spark, "pieces")
    rows.mapInArrow(_pieces(id_col, length, end_id, tokenizer), T.StructType(cols)).write.parquet(path)
    pieces = spark.read.schema(T.StructType(cols)).parquet(path)

    more = [T.StructField("offset", T.LongType()), T.StructField("sequence_id", T.LongType())]
    full = pieces.where(F.col("length") == length).select(
        *pieces.drop("row").columns, F.lit(0).cast("long").alias("offset"), F.monotonically_increasing_id().alias("sequence_id"))
    part = pieces.where(F.col("length") < length)
    shards = max(1, -(-part.count() // shard_pieces))
    dealt = part.withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.lit(shards)).cast("int")).drop("row")
    placed = dealt.groupBy("shard").applyInPandas(_place_shard(length), T.StructType([*cols[:-1], *more]))
    return full.unionByName(placed).select(
        id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
