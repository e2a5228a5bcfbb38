"""Product codes of vectors; the nearest entry is found through memoised grid cells.

Components become integers, vectors are cut into parts, and each part position
has a codebook of at most 256 entries, refined by a few rounds of assignment
and averaging. All arithmetic is in integers, so that results don't depend on
the order of rows, tasks or retries.

To assign a part, its coarse grid cell is looked up. For a new cell each
entry's least and greatest distance to the cell's box are summed up from one
small table a dimension; entries whose least distance is over another's
greatest are dominated everywhere in the box and drop out. What is left is kept
for the cell, and only that is evaluated exactly. Cells are kept up to a bound,
then forgotten; results don't depend on it.

Each round is one pass over the rows: a task sums its own parts by entry and
hands on one row an entry. Only codebooks reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.llm.common import shared_path, totals
from reviewlake.llm.word_tokens import ragged

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
CELL = 32                        # cell width, in integer units
_KEEP_CELLS, _BLOCK = 1 << 16, 2048


def component_limit(dim: int) -> int:
    """Largest absolute component for which error sums fit in 64 bits."""
    return min(1 << 26, int((2 ** 61 // max(dim, 1)) ** 0.5) // 2)


class Cells:
    """Nearest entries of one codebook, by memoised grid cells."""

    def __init__(self, book: np.ndarray, width: int = CELL, keep: int = _KEEP_CELLS):
        self.book, self.width, self.keep = book.astype(np.int64), width, keep
        self.seen: dict[bytes, np.ndarray] = {}

    def _candidates(self, cells: np.ndarray) -> list[np.ndarray]:
        """For each cell the entries that are nearest somewhere in its box, ascending."""
        reach = (np.abs(cells).max(initial=0) + 1) * self.width + np.abs(self.book).max(initial=0)
        kind = np.int32 if cells.shape[1] * reach ** 2 < 1 << 31 else np.int64
        near, far = np.zeros((2, len(cells), len(self.book)), kind)
        for j in range(cells.shape[1]):
            level, at = np.unique(cells[:, j], return_inverse=True)
            low = level[:, None] * self.width
            below, above = low - self.book[:, j], self.book[:, j] - (low + self.width - 1)
            near += (np.maximum(np.maximum(below, above), 0) ** 2).astype(kind)[at]
            far += (np.maximum(np.abs(low - self.book[:, j]), np.abs(low + self.width - 1 - self.book[:, j])) ** 2).astype(kind)[at]
        row, entry = np.nonzero(near <= far.min(1)[:, None])
        return np.split(entry.astype(np.int16), np.cumsum(np.bincount(row, minlength=len(cells)))[:-1])

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each row of ``x``; ties go to the lower entry."""
        parts = [self._nearest(x[lo:lo + _BLOCK]) for lo in range(0, len(x), _BLOCK)]
        return tuple(np.concatenate(p) if parts else np.zeros(0, np.int64) for p in zip(*parts)) if parts else (
            np.zeros(0, np.int64), np.zeros(0, np.int64))

    def _nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cells, at = np.unique(x // self.width, axis=0, return_inverse=True)
        keys = [c.tobytes() for c in cells]
        new = [i for i, k in enumerate(keys) if k not in self.seen]
        if len(self.seen) + len(new) > self.keep:
            self.seen.clear()
            new = list(range(len(keys)))
        if new:
            self.seen.update(zip([keys[i] for i in new], self._candidates(cells[new])))
        lists = [self.seen[k] for k in keys]
        size = np.array([len(c) for c in lists])
        entry = np.concatenate(lists).astype(np.int64)[ragged((np.cumsum(size) - size)[at.ravel()], size[at.ravel()])]
        size = size[at.ravel()]
        diff = np.repeat(x, size, axis=0) - self.book[entry]
        dist = np.einsum("ij,ij->i", diff, diff)
        start = np.cumsum(size) - size
        best = np.minimum.reduceat(dist, start)
        return np.minimum.reduceat(np.where(dist == np.repeat(best, size), entry, len(self.book)), start), best


@dataclass
class Codebooks:
    """Entries of each part position, and where the parts begin and end."""
    bounds: list[int]
    books: list[np.ndarray]

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(str(c) for b in self.books for c in b.ravel().tolist()).encode()).hexdigest()

    def assign(self, x: np.ndarray, cells: list[Cells]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(part, entries, squared distances) for each part position."""
        for lo, hi, c in zip(self.bounds[:-1], self.bounds[1:], cells):
            part = np.ascontiguousarray(x[:, lo:hi])
            yield (part, *c.nearest(part))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def _sums(books: Codebooks) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(b) for b in books.books]
        sums, counts = [np.zeros_like(b) for b in books.books], [np.zeros(len(b), np.int64) for b in books.books]
        for batch in batches:
            x = _matrix(batch.column(0), books.bounds[-1])
            for s, n, (part, entry, _) in zip(sums, counts, books.assign(x, cells)):
                order = np.argsort(entry, kind="stable")
                used, first = np.unique(entry[order], return_index=True)
                if len(used):
                    s[used] += np.add.reduceat(part[order], first, axis=0)
                n += np.bincount(entry, minlength=len(n))
        for p, (s, n) in enumerate(zip(sums, counts)):
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), p, np.int32)), pa.array(used.astype(np.int32)), pa.array(n[used]),
                 pa.array(list(s[used]), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])
    return run


def _codes(books: Codebooks, names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(b) for b in books.books]
        for batch in batches:
            done = list(books.assign(_matrix(batch.column(2), books.bounds[-1]), cells))
            code = np.stack([entry for _, entry, _ in done], 1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([c.tobytes().hex() for c in code], pa.string()),
                 pa.array(sum(dist for *_, dist in done))], names=names)
    return run


def _kept(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> tuple[DataFrame, int]:
    """(id, label, comps) of the usable vectors in a written table, and their length."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"),
                          F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    common = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = common["dim"] if common else 0
    limit = float(component_limit(dim))
    whole = F.transform("v", lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(limit)), F.lit(-limit))).cast("int"))
    rows = rows.where(F.size("v") == dim).select("id", "label", whole.alias("comps"))
    path = shared_path(spark, "vectors")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path), dim


def train(kept: DataFrame, dim: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks from (id, comps) rows: the first ``entries`` vectors by id, then ``rounds`` refinements."""
    # nulls after all ids; vectors that share an id by their components
    first = kept.orderBy(F.asc_nulls_last("id"), "comps").limit(entries).collect()
    start = np.array([r["comps"] for r in first], np.int64).reshape(len(first), dim)
    bounds = [p * dim // parts for p in range(parts + 1)]
    books = Codebooks(bounds, [start[:, lo:hi].copy() for lo, hi in zip(bounds[:-1], bounds[1:])])
    for _ in range(rounds if len(start) else 0):
        sums = kept.select("comps").mapInArrow(_sums(books), "part int, entry int, n long, sums array<long>")
        means = (sums.select("part", "entry", "n", F.posexplode("sums").alias("pos", "s"))
                 .groupBy("part", "entry", "pos").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).toPandas())
        for p, rows in means.groupby("part"):
            books.books[p][rows["entry"], rows["pos"]] = rows["s"].to_numpy() // rows["n"].to_numpy()
    return books


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", *,
             scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """(rows, codebooks); one row (id, label, code, error, label_error) per usable vector.

    Vectors that are null, empty or hold a null, NaN or infinite component are
    dropped, as are those whose length isn't the commonest one (of equally
    common ones the longest); components are floor(``scale`` * x), cut off at
    ``component_limit``. ``code`` has two hex digits a part; a length that
    ``parts`` doesn't divide makes some parts one longer. ``label_error`` adds
    up the error over the rows of one label, null labels together, and is null
    where the sum leaves 64 bits. Repeated rows and null ids are rows like
    others. The result has these five columns only, whatever else there is.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be 1 to 256")
    kept, dim = _kept(vectors, id_col, vector_col, label_col, scale)
    books = train(kept, dim, parts, entries, rounds)
    names = [id_col, "label", "code", "error"]
    kinds = [kept.schema["id"].dataType, kept.schema["label"].dataType, T.StringType(), T.LongType()]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(["id", "label", "code", "error"], kinds)])
    path = shared_path(kept.sparkSession, "codes")
    kept.mapInArrow(_codes(books, schema.names), schema).write.parquet(path)
    codes = kept.sparkSession.read.schema(schema).parquet(path)
    sums = totals(codes, "label", label_error=F.expr("try_sum(error)"))
    joined = codes.alias("c").join(sums.alias("s"), F.col("c.label").eqNullSafe(F.col("s.label")), "left")
    return joined.select(*[F.col(f"c.{s}").alias(n) for s, n in zip(schema.names, names)], "label_error"), books
