"""Packing under several limits at once: vector bin packing for instruction data.

An example is its prompt's ids (optional, without loss), its text's ids and an
end id. A sequence is filled under three limits: tokens, segments (pieces) and
loss-bearing tokens. The next piece is the one whose demand has the largest dot
product with what the sequence has left, each dimension measured by its limit.
Where no whole example fits any more, one is cut to fill the sequence to the
last token. A sequence that has to close earlier (a limit other than tokens, or
nothing is left) closes at a power of two and gives the rest back, so that it
needs no padding either.

Packing needs no shuffle: each task packs the examples it reads, in rounds of a
bounded number of tokens, and every round leaves at most a few short sequences.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.llm.word_tokens import ragged, word_encoder

LENGTH, SEGMENTS, END_ID = 4096, 128, 2
ROUND_TOKENS, ROUND_ROWS = 4_000_000, 65_536        # a round packs once it has as many
_SLICE = 4 << 20                                    # bytes of text encoded at once; one text at least
_OUT = 1 << 20                                      # ids handed back at once; one piece at least


class _Pool:
    """Pieces yet to be placed, by kind: (tokens, loss-bearing tokens)."""

    def __init__(self, tokens: np.ndarray, loss: np.ndarray):
        kinds, at = np.unique(np.stack([tokens, loss], 1), axis=0, return_inverse=True)
        order = np.argsort(at.ravel(), kind="stable")
        counts = np.bincount(at.ravel(), minlength=len(kinds))
        self.tokens, self.loss = kinds[:, 0].copy(), kinds[:, 1].copy()
        # of equal pieces the first comes first
        self.items = [order[e - c:e][::-1].tolist() for c, e in zip(counts, np.cumsum(counts))]
        self.kind = {(t, s): k for k, (t, s) in enumerate(kinds.tolist())}
        self.left = len(tokens)

    def add(self, item: int, tokens: int, loss: int) -> None:
        k = self.kind.get((tokens, loss))
        if k is None:
            k = self.kind[tokens, loss] = len(self.items)
            self.tokens, self.loss = np.append(self.tokens, tokens), np.append(self.loss, loss)
            self.items.append([])
        elif not self.items[k]:
            self.tokens[k], self.loss[k] = tokens, loss
        self.items[k].append(item)
        self.left += 1

    def take(self, k: int) -> int:
        item = self.items[k].pop()
        self.left -= 1
        if not self.items[k]:
            self.tokens[k] = -1                     # this kind fits nowhere
        return item


def place(size: np.ndarray, free: np.ndarray, length: int = LENGTH, segments: int = SEGMENTS,
          max_loss: int | None = None) -> np.ndarray:
    """Rows (example, start, length, sequence, offset) that hold every token once.

    ``size`` tokens in each example, the first ``free`` of them without loss.
    """
    max_loss = length if max_loss is None else max_loss
    out, made = [], 0
    # parts of examples: (example, start, tokens, tokens without loss at the start)
    parts: list[tuple[int, int, int, int]] = []
    for i, (n, f) in enumerate(zip(size.tolist(), free.tolist())):
        at = 0
        while n - at > length or (n - at) - max(f - at, 0) > max_loss:
            k = min(length, max(f - at, 0) + max_loss)
            if k == length:
                out.append((i, at, k, made, 0))
                made += 1
            else:
                parts.append((i, at, k, max(f - at, 0)))
            at += k
        if n > at:
            parts.append((i, at, n - at, max(f - at, 0)))
    if not parts:
        return np.array(out, np.int64).reshape(-1, 5)
    table = np.array(parts, np.int64)
    pool = _Pool(table[:, 2], np.maximum(table[:, 2] - table[:, 3], 0))

    def put_back(example: int, start: int, tokens: int, unpaid: int) -> None:
        parts.append((example, start, tokens, unpaid))
        pool.add(len(parts) - 1, tokens, max(tokens - unpaid, 0))

    while pool.left:
        room, slots, loss = length, segments, max_loss
        mine: list[tuple[int, int, int, int]] = []
        while room and slots and pool.left:
            t, s = pool.tokens, pool.loss
            # dot product of demand and rest, in units of the limits; a segment each adds the same to all
            score = np.where((t > 0) & (t <= room) & (s <= loss),
                             t * (room / length ** 2) + s * (loss / max_loss ** 2) + slots / segments ** 2, -1.0)
            k = int(score.argmax())
            if score[k] >= 0:
                example, start, tokens, unpaid = parts[pool.take(k)]
            else:
                # none fits whole: cut the one that fills most, of those the longest
                fill = np.where(t > 0, np.minimum(np.minimum(t, room), t - s + loss), 0)
                if fill.max() < 1:
                    break
                k = int(np.where(fill == fill.max(), t, 0).argmax())
                take = int(fill[k])
                example, start, tokens, unpaid = parts[pool.take(k)]
                put_back(example, start + take, tokens - take, max(unpaid - take, 0))
                tokens = take
            mine.append((example, start, tokens, unpaid))
            room, slots, loss = room - tokens, slots - 1, loss - max(tokens - unpaid, 0)
        used = length - room
        if room:
            over = used - (1 << (used.bit_length() - 1))
            while over:
                example, start, tokens, unpaid = mine.pop()
                back = min(over, tokens)
                put_back(example, start + tokens - back, back, max(unpaid - (tokens - back), 0))
                if tokens > back:
                    mine.append((example, start, tokens - back, min(unpaid, tokens - back)))
                over -= back
        offset = 0
        for example, start, tokens, _ in mine:
            out.append((example, start, tokens, made, offset))
            offset += tokens
        made += 1
    return np.array(out, np.int64).reshape(-1, 5)


def _run(names: list[str], length: int, segments: int, max_loss: int | None, end_id: int,
         path: str | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        first = TaskContext.get().partitionId() << 32
        rows, ids, size, free = [], [], [], []

        def encoded(batch):
            """Fills the round's lists from a few texts."""
            a, na = encoder.encode(batch.column(1))
            b, nb = encoder.encode(batch.column(2), end_id)
            both = np.empty(len(a) + len(b), np.uint32)
            is_prompt = np.repeat(np.tile([True, False], len(na)), np.stack([na, nb], 1).ravel())
            both[is_prompt], both[~is_prompt] = a, b
            rows.append(batch.column(0))
            ids.append(both)
            size.append(na + nb)
            free.append(na)

        def packed():
            nonlocal first
            n = np.concatenate(size)
            at = place(n, np.concatenate(free), length, segments, max_loss)
            flat, whole = np.concatenate(ids), pa.concat_arrays(rows)
            for x in (rows, ids, size, free):
                x.clear()
            start = np.cumsum(n) - n
            group = (np.cumsum(at[:, 2]) - at[:, 2]) // _OUT
            for some in np.split(at, np.flatnonzero(np.diff(group)) + 1):
                # the ids of all pieces, one after the other, are the values of one binary array
                values = flat[ragged(start[some[:, 0]] + some[:, 1], some[:, 2])].astype("<u4", copy=False)
                offsets = np.append(0, np.cumsum(some[:, 2]) * 4).astype(np.int32)
                value = pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(offsets), pa.py_buffer(values)])
                yield pa.RecordBatch.from_arrays(
                    [whole.take(pa.array(some[:, 0])), pa.array(some[:, 1]), pa.array(some[:, 2]), pa.array(n[some[:, 0]]),
                     pa.array(some[:, 3] + first), pa.array(some[:, 4]), value], names=names)
            first += int(at[:, 3].max()) + 1

        for batch in batches:
            bytes_ = sum(np.nan_to_num(pc.binary_length(batch.column(c)).to_numpy(zero_copy_only=False)) for c in (1, 2))
            group = (np.cumsum(bytes_ + 1) - bytes_ - 1) // _SLICE
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if hi > lo:
                    encoded(batch.slice(lo, hi - lo))
                    if sum(map(len, ids)) >= ROUND_TOKENS or sum(map(len, size)) >= ROUND_ROWS:
                        yield from packed()
        if rows:
            yield from packed()
    return run


def pack_examples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prompt_col: str | None = None, *,
                  length: int = LENGTH, segments: int = SEGMENTS, max_loss: int | None = None, end_id: int = END_ID,
                  tokenizer: str | None = None) -> DataFrame:
    """One row per piece: id, start, length, doc_tokens, sequence_id, offset, ids.

    ``ids`` are the piece's token ids, little-endian unsigned 32-bit. A
    sequence has at most ``length`` tokens, ``segments`` pieces and ``max_loss``
    loss-bearing tokens (default: as many as tokens); it is full or has a power
    of two of them. Tokens of ``prompt_col`` come first and bear no loss; a
    null prompt or text is empty, and an empty example is the end id alone.
    Rows are packed one by one: repeated rows and null ids are examples like
    others. The result has these seven columns only, whatever else ``docs``
    has. A sequence's pieces come from one task: ``docs`` should read the same
    rows when a lost task is run again, as tables do.
    """
    if not (length >= 1 and segments >= 1 and (max_loss is None or max_loss >= 1)):
        raise ValueError("limits must be at least 1")
    names = [id_col, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    prompt = F.col(f"`{prompt_col}`") if prompt_col else F.lit(None)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), prompt.cast("string").alias("prompt"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           *[T.StructField(c, T.LongType()) for c in names[1:-1]], T.StructField("ids", T.BinaryType())])
    return rows.mapInArrow(_run(names, length, segments, max_loss, end_id, tokenizer), schema)
