"""Scoring by an interpolated modified Kneser-Ney bigram model.

Spark counts words, then bigrams of word ranks: each task reduces its texts to
distinct keys and counts, cuts them into shards, and a shard's counts meet in
one task, which writes them as sorted arrays into the shared folder. Workers
map these files into memory and look keys up by binary search; nothing of the
model passes through the driver but a few sums per shard.

A word's shard is its hash's range, so its rank is the model's word id. A
bigram's shard is a hash of its first word, or of both where the first word is
so frequent that it would fill a shard. The number of shards grows with the
text, their size doesn't.

    p(w|u) = max(c(u,w) - D, 0) / c(u) + (D1 N1(u) + D2 N2(u) + D3 N3(u)) / c(u) * p(w)

with the lower order p(w) made in the same way from the number of different
words before w, down to 1 / (V + 1). Words unknown to the model share that
last part. The shared folder must be a file system that workers can open
(``file:`` or a mount); sums are exact up to 64-bit word hashes.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.llm.common import shared_path, text_or_empty
from reviewlake.llm.words import U64, Words, mix, string_slices

SHARD_BYTES, HELD_ENTRIES, BLOCK = 32 << 20, 3_000_000, 1 << 17
END = U64(0xE14D5A7C39B26F08)            # stands for the end of a text among word hashes
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20


@dataclass
class Model:
    """Where the arrays are, and the sums that probabilities need."""
    root: str
    shards: int
    starts: np.ndarray                    # rank of each word shard's first word; then V, V + 1
    tokens: int
    hot: int
    discounts: tuple[float, float, float]
    lower_discounts: tuple[float, float, float]
    types: int = 0                        # different bigrams
    lower_rest: float = 1.0               # what the lower order leaves to 1 / (V + 1)

    @property
    def vocabulary(self) -> int:
        return int(self.starts[self.shards])


_OPEN: dict[str, np.ndarray] = {}


def _load(path: str) -> np.ndarray | None:
    """A mapped array; None for a shard without rows."""
    if path not in _OPEN:
        if len(_OPEN) > 4096:
            _OPEN.clear()
        _OPEN[path] = np.load(path, mmap_mode="r") if os.path.exists(path) else None
    return _OPEN[path]


def _save(path: str, array: np.ndarray) -> None:
    """Whole or not at all: a task that runs again writes the same."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as f:
        np.save(f, array)
    os.replace(part, path)


def _range(h: np.ndarray, shards: int) -> np.ndarray:
    return (((h >> U64(32)) * U64(shards)) >> U64(32)).astype(np.int64)


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes with an END after each document, offsets by document)."""
    words = Words(_FOLD[data], offsets)
    n = len(offsets) - 1
    out = np.full(len(words) + n, END, U64)
    doc = np.repeat(np.arange(n), np.diff(words.first))
    out[np.arange(len(words)) + doc] = words.hashes()
    return out, words.first + np.arange(n + 1)


def _segments(shard: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(shard, from, to) of a sorted array of shard numbers."""
    cut = np.concatenate(([0], np.flatnonzero(shard[1:] != shard[:-1]) + 1, [len(shard)])) if len(shard) else [0]
    for a, b in zip(cut[:-1], cut[1:]):
        yield int(shard[a]), int(a), int(b)


def _unique(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if counts is None:
        return np.unique(keys, return_counts=True)
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[at], np.add.reduceat(counts[order], at)


def _blocks(shard: np.ndarray, keys: np.ndarray, values: np.ndarray, kind: int = 0) -> Iterator[pa.RecordBatch]:
    """Rows (shard, kind, keys as differences, values), by shard in ascending keys."""
    order = np.argsort(shard, kind="stable")
    shard, keys, values = shard[order], keys[order], values[order]
    for s, a, b in _segments(shard):
        for lo in range(a, b, BLOCK):
            k = keys[lo:min(lo + BLOCK, b)]
            v = np.ascontiguousarray(values[lo:min(lo + BLOCK, b)].T.astype(np.uint32))
            yield pa.RecordBatch.from_arrays(
                [pa.array([s], pa.int32()), pa.array([kind], pa.int32()),
                 pa.array([np.diff(k, prepend=U64(0)).tobytes()], pa.binary()), pa.array([v.tobytes()], pa.binary())],
                names=["shard", "kind", "keys", "counts"])


_BLOCK_SCHEMA = "shard int, kind int, keys binary, counts binary"


def _unpack(table: pa.Table, kind: int, width: int = 1) -> tuple[np.ndarray, np.ndarray]:
    keys, values = [np.zeros(0, U64)], [np.zeros((0, width), np.int64)]
    for k, a, b in zip(*(table.column(c).to_pylist() for c in ("kind", "keys", "counts"))):
        if k == kind:
            keys.append(np.cumsum(np.frombuffer(a, U64), dtype=U64))
            values.append(np.frombuffer(b, np.uint32).reshape(width, -1).T.astype(np.int64))
    return np.concatenate(keys), np.concatenate(values)


def _counted(find: Callable, shard_of: Callable) -> Callable:
    """Distinct keys of a task's texts with their counts, cut into shards; held keys are bounded."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for b in batches:
            for _, _, data, offsets in string_slices(b.column(0)):
                held.append(_unique(find(data, offsets)))
                size += len(held[-1][0])
                if size > 2 * HELD_ENTRIES:
                    held = [_unique(*(np.concatenate(x) for x in zip(*held)))]
                    size = len(held[0][0])
                    if size > HELD_ENTRIES:
                        yield from _blocks(shard_of(held[0][0]), *held[0])
                        held, size = [], 0
        if held:
            keys, counts = _unique(*(np.concatenate(x) for x in zip(*held)))
            yield from _blocks(shard_of(keys), keys, counts)
    return run


def _write_words(root: str) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        s = table.column("shard")[0].as_py()
        keys, counts = _unpack(table, 0)
        keys, counts = _unique(keys, counts[:, 0])
        _save(f"{root}/words/{s}.npy", keys)
        _save(f"{root}/counts/{s}.npy", counts)
        return pa.table({"shard": pa.array([s], pa.int32()), "words": [len(keys)], "tokens": [int(counts.sum())]})
    return run


class Lookup:
    """Reads the model's arrays from inside a worker."""

    def __init__(self, model: Model):
        self.m = model

    def ranks(self, hashes: np.ndarray) -> np.ndarray:
        """Word ids of ascending hashes, -1 where unknown."""
        out = np.full(len(hashes), -1, np.int64)
        for s, a, b in _segments(_range(hashes, self.m.shards)):
            words = _load(f"{self.m.root}/words/{s}.npy")
            if words is not None:
                at = np.minimum(np.searchsorted(words, hashes[a:b]), len(words) - 1)
                out[a:b] = np.where(words[at] == hashes[a:b], self.m.starts[s] + at, -1)
        return out

    def of_words(self, ids: np.ndarray, folder: str, width: int) -> np.ndarray:
        """(width, ids) values of ascending word ids; 0 for -1."""
        out = np.zeros((width, len(ids)), np.int64)
        known = np.flatnonzero(ids >= 0)
        ids = ids[known]
        for s, a, b in _segments(np.searchsorted(self.m.starts, ids, "right") - 1):
            values = _load(f"{self.m.root}/{folder}/{s}.npy")
            if values is not None:
                out[:, known[a:b]] = np.atleast_2d(values)[:, ids[a:b] - self.m.starts[s]]
        return out

    def bigram_shards(self, keys: np.ndarray) -> np.ndarray:
        first = keys // U64(self.m.vocabulary + 1)
        ids, back = np.unique(first, return_inverse=True)
        ids = ids.astype(np.int64)
        start = ids == self.m.vocabulary
        often = start | (self.of_words(np.where(start, -1, ids), "counts", 1)[0] >= self.m.hot)
        return _range(mix(np.where(often[back], keys, first)), self.m.shards)

    def bigrams(self, keys: np.ndarray) -> np.ndarray:
        """Counts of ascending bigram keys."""
        out = np.zeros(len(keys), np.int64)
        shard = self.bigram_shards(keys)
        order = np.argsort(shard, kind="stable")
        for s, a, b in _segments(shard[order]):
            there = _load(f"{self.m.root}/bigrams/{s}.npy")
            if there is None:
                continue
            at, want = order[a:b], keys[order[a:b]]
            place = np.minimum(np.searchsorted(there, want), len(there) - 1)
            found = np.where(there[place] == want, _load(f"{self.m.root}/small/{s}.npy")[place], 0).astype(np.int64)
            full = np.flatnonzero(found == 255)
            if len(full):
                large = _load(f"{self.m.root}/large/{s}.npy")
                found[full] = large[1][np.searchsorted(large[0], want[full])]
            out[at] = found
        return out

    def bigram_keys(self, data: np.ndarray, offsets: np.ndarray):
        """(keys, known, token ids, distinct ids, offsets) of a slice's bigrams; unknown ones are marked."""
        tokens, off = _tokens(data, offsets)
        hashes, back = np.unique(tokens, return_inverse=True)
        ids = self.ranks(hashes)
        now = ids[back]
        before = np.empty_like(now)
        before[1:] = now[:-1]
        before[off[:-1]] = self.m.vocabulary
        known = (now >= 0) & (before >= 0)
        keys = before.astype(U64) * U64(self.m.vocabulary + 1) + now.astype(U64)
        return keys, known, back, ids, before, off


def _bigram_finder(model: Model) -> Callable:
    look = Lookup(model)

    def find(data, offsets):
        keys, known, *_ = look.bigram_keys(data, offsets)
        return keys[known]
    return find


def _write_bigrams(model: Model) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        s = table.column("shard")[0].as_py()
        keys, counts = _unpack(table, 0)
        keys, counts = _unique(keys, counts[:, 0])
        _save(f"{model.root}/bigrams/{s}.npy", keys)
        _save(f"{model.root}/small/{s}.npy", np.minimum(counts, 255).astype(np.uint8))
        often = counts >= 255
        _save(f"{model.root}/large/{s}.npy", np.stack([keys[often], counts[often].astype(U64)]))
        width = U64(model.vocabulary + 1)
        first, second = keys // width, keys % width
        out = []
        # of first words: tokens, and how many bigrams occur once, twice, more often
        at = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1])))
        per = np.stack([np.add.reduceat(x.astype(np.int64), at) for x in (counts, counts == 1, counts == 2, counts > 2)], 1)
        ids = first[at]
        out += _blocks(_home(model, ids), ids, per, 1)
        # of second words: how many different words before them
        ids, n = np.unique(second, return_counts=True)
        out += _blocks(_home(model, ids), ids, n[:, None], 2)
        sizes = np.array([[int((counts == i).sum()) for i in (1, 2, 3, 4)]])
        out += _blocks(np.array([model.shards]), np.array([s], U64), sizes, 3)
        return pa.Table.from_batches(out)
    return run


def _home(model: Model, ids: np.ndarray) -> np.ndarray:
    return np.searchsorted(model.starts, ids.astype(np.int64), "right") - 1


def _write_stats(model: Model) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        s = table.column("shard")[0].as_py()
        n = int(model.starts[s + 1] - model.starts[s])
        out = np.zeros((5, n), np.int64)
        ids, per = _unpack(table, 1, 4)
        at = (ids.astype(np.int64) - model.starts[s])
        np.add.at(out[:4].T, at, per)
        ids, per = _unpack(table, 2)
        np.add.at(out[4], ids.astype(np.int64) - model.starts[s], per[:, 0])
        _save(f"{model.root}/stats/{s}.npy", out)
        sizes = _unpack(table, 3, 4)[1].sum(axis=0)
        lower = [int((out[4] == i).sum()) for i in (1, 2, 3, 4)] + [int((out[4] > 2).sum()), int(out[4].sum())]
        return pa.table({"higher": pa.array([sizes.tolist()], pa.list_(pa.int64())), "lower": pa.array([lower], pa.list_(pa.int64()))})
    return run


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney's three discounts from the counts of counts 1 to 4.

    Where a corpus is too small to give one, half the count is taken off.
    """
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    out = []
    for i in (1, 2, 3):
        d = i - (i + 1) * y * n[i] / n[i - 1] if n[i - 1] and n[i] else i / 2
        out.append(d if 0.05 * i <= d <= i else i / 2)
    return tuple(out)


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Count the model over all given texts; null texts are empty."""
    spark = docs.sparkSession
    root = shared_path(spark, "lm")
    if root.startswith("file:"):
        root = "/" + root[len("file:"):].lstrip("/")
    elif "://" in root:
        raise ValueError("the language model's arrays need a spark.checkpoint.dir that workers can open as files")
    texts = docs.select(text_or_empty(text_col).alias("t"))
    total = texts.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    shards = max(8, -(-int(total) // SHARD_BYTES))

    blocks = texts.mapInArrow(_counted(lambda data, off: _tokens(data, off)[0], lambda k: _range(k, shards)), _BLOCK_SCHEMA)
    rows = blocks.groupBy("shard").applyInArrow(_write_words(root), "shard int, words long, tokens long").collect()
    size = np.zeros(shards, np.int64)
    for r in rows:
        size[r["shard"]] = r["words"]
    starts = np.concatenate(([0], np.cumsum(size)))
    starts = np.append(starts, starts[-1] + 1)
    tokens = sum(r["tokens"] for r in rows)
    model = Model(root, shards, starts, tokens, max(1, tokens // (4 * shards)), (0, 0, 0), (0, 0, 0))
    if not tokens:
        return model
    if model.vocabulary >= 1 << 32:
        raise ValueError("a bigram key holds ranks of up to 2**32 words")

    look = Lookup(model)
    blocks = texts.mapInArrow(_counted(_bigram_finder(model), look.bigram_shards), _BLOCK_SCHEMA)
    found = blocks.groupBy("shard").applyInArrow(_write_bigrams(model), _BLOCK_SCHEMA)
    sums = found.groupBy("shard").applyInArrow(_write_stats(model), "higher array<long>, lower array<long>").collect()
    model.discounts = discounts([sum(r["higher"][i] for r in sums) for i in range(4)])
    lower = [sum(r["lower"][i] for r in sums) for i in range(6)]
    model.lower_discounts = discounts(lower[:4])
    model.types = lower[5]
    d = model.lower_discounts
    model.lower_rest = (d[0] * lower[0] + d[1] * lower[1] + d[2] * lower[4]) / model.types
    return model


def probabilities(m: Model, pair: np.ndarray, stats: np.ndarray, before: np.ndarray) -> np.ndarray:
    """p(w|u) from counts of (u, w), and the stats columns of w and of u."""
    nc = stats[4]
    lower = m.lower_rest / (m.vocabulary + 1)
    if m.types:
        lower = lower + np.maximum(nc - _discount(nc, m.lower_discounts), 0) / m.types
    c = np.maximum(before[0], 1)
    rest = (m.discounts[0] * before[1] + m.discounts[1] * before[2] + m.discounts[2] * before[3]) / c
    higher = np.maximum(pair - _discount(pair, m.discounts), 0) / c + rest * lower
    return np.where(before[0] > 0, higher, lower)


def _discount(n: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(n, 3)]


def _score(model: Model, text_col: str, new: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Lookup(model)
        unseen = model.tokens + 0.1 * (model.vocabulary + 1)
        for b in batches:
            out = [[], [], [], []]
            for _, _, data, offsets in string_slices(b.column(text_col)):
                keys, known, back, ids, before, off = look.bigram_keys(data, offsets)
                counts = look.of_words(ids, "counts", 1)[0]
                stats = look.of_words(ids, "stats", 5)
                start = np.zeros((5, 1), np.int64)
                first = _load(f"{model.root}/stats/{model.shards}.npy")
                if first is not None:
                    start[:] = first
                places = np.empty_like(back)              # column of the word before, the last one for the start
                places[1:] = back[:-1]
                places[off[:-1]] = len(ids)
                distinct, at = np.unique(keys[known], return_inverse=True)
                pair = np.zeros(len(back), np.int64)
                pair[known] = look.bigrams(distinct)[at]
                p = probabilities(model, pair, stats[:, back], np.concatenate((stats, start), axis=1)[:, places])
                c = counts[back]
                for o, x in zip(out, (np.ones(len(c)), c > 0, np.log10((c + 0.1) / unseen), np.log10(p))):
                    o.append(np.add.reduceat(x.astype(float), off[:-1]) if len(off) > 1 else np.zeros(0))
            n, known_n, base, score = (np.concatenate(o) if o else np.zeros(0) for o in out)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(n.astype(np.int64)), pa.array(known_n.astype(np.int64)), pa.array(base), pa.array(score)],
                names=[*b.schema.names, *new])
    return run


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` plus n_tokens, n_known, base_score, score (log10 probabilities of the whole text).

    A null or empty text is its end token alone. Without any training token
    every probability is 1. Rows are scored by themselves; columns that have
    one of the new names are replaced.
    """
    new = ["n_tokens", "n_known", "base_score", "score"]
    base = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in new])
    kinds = [T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType()]
    schema = T.StructType([*base.schema.fields, *[T.StructField(n, k) for n, k in zip(new, kinds)]])
    return base.mapInArrow(_score(model, text_col, new), schema)
