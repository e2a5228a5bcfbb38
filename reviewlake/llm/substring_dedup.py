"""Substring dedup on a sparse De Bruijn graph of the corpus.

A word that lies in a window of ``window`` consecutive words whose sequence
also starts elsewhere is removed; every window is judged on the input.

The graph's vertices are ``k``-word anchors, chosen by content (the smallest
hash among the k-mers of a window), so that equal windows hold the same anchor
at the same place and only a few per cent of all positions become rows. The
edges leaving and entering an anchor are the words around it, as far as any
window through the anchor can reach; their hash is the anchor's *context*.

1. Anchors that occur once carry no repeat: a grouped count drops them.
2. Where all occurrences of a repeated anchor have one context, its edges
   don't branch: the path through it compacts, and all windows along it are
   repeats without looking at any of them. A join hands that back to each
   source coordinate.
3. Where contexts differ, paths branch: the windows that have the anchor as
   their smallest are compared one by one, by 128 bits of hash and their
   source coordinates.

Shuffled are the anchors, the windows at branches, and each text once (the
exchange by row key is the same for steps 3 and the removal).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.llm.common import add_row_key, fresh, text_or_empty, totals
from reviewlake.llm.words import BASE, BASE2, U64, Words, mix, sliding, string_slices, windows

WINDOW = 35
ANCHOR = 10

_POWER: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _both_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE2 and of its inverse mod 2**64."""
    if not _POWER or len(_POWER[0][0]) < n:
        inverse = U64(pow(int(BASE2), -1, 1 << 64))
        out = []
        for b in (BASE2, inverse):
            full = np.full(2 * n, b, U64)
            full[0] = 1
            out.append(np.multiply.accumulate(full))
        _POWER[0] = tuple(out)
    return _POWER[0]


class _Anchors:
    """Anchor positions of a slice's words, and what each window starts with."""

    def __init__(self, words: Words, window: int, k: int):
        self.words, self.w = words, window - k + 1
        self.h = words.hashes()
        self.g = windows(self.h, k)
        low = sliding(self.g, self.w, np.minimum)                 # by window start
        ends = np.arange(len(low)) + window
        self.valid = ends <= words.doc_end[:len(low)]
        self.low = np.where(self.valid, low, U64(0))
        spread = np.zeros(len(low) + 2 * (self.w - 1), U64)       # windows that hold each k-mer
        spread[self.w - 1:self.w - 1 + len(low)] = self.low
        top = sliding(spread, self.w, np.maximum)
        self.at = np.flatnonzero((top[:len(self.g)] == self.g) & (self.g != 0)) if len(low) else np.zeros(0, np.int64)
        self.k = k

    def context(self) -> np.ndarray:
        """Hash of all words that a window through the anchor can hold."""
        lo = np.maximum(self.words.doc_start[self.at], self.at - (self.w - 1))
        hi = np.minimum(self.words.doc_end[self.at], self.at + self.k + self.w - 1)
        up, down = _both_powers(len(self.h) + 1)
        with np.errstate(over="ignore"):
            total = np.concatenate(([U64(0)], np.cumsum(self.h * up[:len(self.h)])))
            part = (total[hi] - total[lo]) * down[lo]
            return mix(part + mix(((self.at - lo) * 4096 + (hi - self.at)).astype(U64)))

    def states(self, at: np.ndarray, state: np.ndarray) -> np.ndarray:
        """By window start: the state of the window's smallest anchor."""
        by_place = np.zeros(len(self.g), np.int8)
        by_place[at] = state
        out = np.zeros(len(self.low), np.int8)
        for j in range(self.w if len(at) else 0):
            n = len(self.low)
            out = np.maximum(out, np.where(self.g[j:j + n] == self.low, by_place[j:j + n], 0))
        return np.where(self.valid, out, 0)


BRANCHING, COMPACT = 1, 2


def _find_anchors(window: int, k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, crc = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for lo, hi, data, offsets in string_slices(b.column(2)):
                words = Words(data, offsets)
                a = _Anchors(words, window, k)
                if not len(a.at):
                    continue
                doc = np.searchsorted(words.first, a.at, "right") - 1
                yield pa.RecordBatch.from_arrays([
                    pa.array(key[lo + doc]), pa.array(crc[lo + doc]),
                    pa.array((a.at - words.doc_start[a.at]).astype(np.int32)),
                    pa.array(a.g[a.at].view(np.int64)), pa.array(a.context().view(np.int64))],
                    names=["key", "crc", "place", "anchor", "context"])
    return run


def _lists(col: pa.Array, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of a list column's rows lo..hi; null lists are empty."""
    part = col.slice(lo, hi - lo)
    size = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(part), 0))
    return np.repeat(np.arange(hi - lo), size), part.flatten().to_numpy(zero_copy_only=False)


def _marked(b: pa.RecordBatch, marks: str, lo: int, hi: int, words: Words, a: _Anchors) -> np.ndarray:
    row, coded = _lists(b.column(marks), lo, hi)
    coded = coded.astype(np.int64)
    return a.states(words.first[row] + coded // 2, np.where(coded % 2, COMPACT, BRANCHING))


def _branch_windows(window: int, k: int, key: str, crc: str, text: str, marks: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, crcs = (b.column(c).to_numpy(zero_copy_only=False) for c in (key, crc))
            for lo, hi, data, offsets in string_slices(b.column(text)):
                words = Words(data, offsets)
                a = _Anchors(words, window, k)
                at = np.flatnonzero(_marked(b, marks, lo, hi, words, a) == BRANCHING)
                if not len(at):
                    continue
                doc = np.searchsorted(words.first, at, "right") - 1
                hashes = [windows(a.h, window, base)[at].view(np.int64) for base in (BASE, BASE2)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys[lo + doc]), pa.array(crcs[lo + doc]),
                    pa.array((at - words.doc_start[at]).astype(np.int32)), *map(pa.array, hashes)],
                    names=["key", "crc", "place", "h1", "h2"])
    return run


def _remove(window: int, k: int, text: str, marks: str, found: str, new: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_removed, kept = [], [], []
            for lo, hi, data, offsets in string_slices(b.column(text)):
                words = Words(data, offsets)
                a = _Anchors(words, window, k)
                repeat = _marked(b, marks, lo, hi, words, a) == COMPACT
                row, place = _lists(b.column(found), lo, hi)
                repeat[words.first[row] + place] = True
                edge = np.zeros(len(words) + 1, np.int64)
                at = np.flatnonzero(repeat)
                edge[at] += 1
                edge[at + window] -= 1
                stays = np.cumsum(edge[:-1]) == 0
                kept += _joined(words, stays)
                n_words.append(np.diff(words.first))
                gone = np.concatenate(([0], np.cumsum(~stays)))
                n_removed.append(gone[words.first[1:]] - gone[words.first[:-1]])
            cat = lambda x: pa.array(np.concatenate(x).astype(np.int64) if x else [], pa.int64())
            same = [c for c in b.schema.names if c not in (marks, found)]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in same] + [cat(n_words), cat(n_removed), pa.array(kept, pa.string())],
                names=same + new)
    return run


def _joined(words: Words, stays: np.ndarray) -> list[str]:
    """Each document's staying words, joined by one space."""
    start, end = words.start[stays], words.end[stays]
    size = end - start
    # every word's bytes and one space after it, gathered in one go
    at = np.concatenate(([0], np.cumsum(size + 1)))
    out = np.full(int(at[-1]), 0x20, np.uint8)
    inside = np.ones(len(out), bool)
    inside[at[1:] - 1] = False
    edge = np.zeros(len(words.data) + 1, np.int8)
    edge[start] += 1
    edge[end] -= 1
    out[inside] = words.data[np.cumsum(edge[:-1]).astype(bool)]
    left = np.concatenate(([0], np.cumsum(stays)))[words.first]
    raw = out.tobytes()
    return [raw[at[i]:max(at[j] - 1, at[i])].decode("utf-8") for i, j in zip(left[:-1], left[1:])]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                   window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``docs`` plus n_words, n_removed and kept_text (the words that stay, joined by a space).

    Null and empty texts have no word. A document shorter than the window
    loses nothing. Rows that repeat an id and text are separate places: their
    windows repeat, so all of them are removed from each row. A null id is an
    id like any other. Columns that have one of the new names are replaced.
    """
    if not 0 < anchor <= window:
        raise ValueError("the anchor must fit into the window")
    new = ["n_words", "n_removed", "kept_text"]
    base = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in new])
    key, crc, marks, found = fresh(docs, "key", "crc", "marks", "found")
    base = add_row_key(base, id_col, text_col, key, crc)

    anchors = base.select(key, crc, text_or_empty(text_col).alias("t")).mapInArrow(
        _find_anchors(window, anchor), "key long, crc long, place int, anchor long, context long")
    repeated = (totals(anchors, "anchor", n=F.count(F.lit(1)), lo=F.min("context"), hi=F.max("context"))
                .where("n > 1").select("anchor", (F.col("lo") == F.col("hi")).cast("int").alias("compact")))
    # a place and its state in one number: 2 * place + (1 if the path compacts)
    marked = (anchors.join(repeated, "anchor")
              .groupBy("key", "crc")
              .agg(F.collect_list(F.col("place").cast("long") * 2 + F.col("compact")).alias(marks)))
    marked = marked.withColumnsRenamed({"key": key, "crc": crc})
    texts = base.join(marked, [key, crc], "left")

    # the same join as below, unfiltered and unpruned, so that its exchange of the texts is reused
    at_branches = texts.mapInArrow(
        _branch_windows(window, anchor, key, crc, text_col, marks), "key long, crc long, place int, h1 long, h2 long")
    twice = totals(at_branches, "h1", "h2", n=F.count(F.lit(1))).where("n > 1").drop("n")
    places = (at_branches.join(twice, ["h1", "h2"]).groupBy("key", "crc")
              .agg(F.collect_set("place").alias(found)).withColumnsRenamed({"key": key, "crc": crc}))

    whole = texts.join(places, [key, crc], "left")
    schema = T.StructType([f for f in whole.schema.fields if f.name not in (marks, found)]
                          + [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                             T.StructField("kept_text", T.StringType())])
    return whole.mapInArrow(_remove(window, anchor, text_col, marks, found, new), schema).drop(key, crc)
