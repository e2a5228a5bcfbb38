"""Language ID by a byte convolutional network, trained here in numpy.

Windows of 256 bytes tile the whole text (the last one ends with it). Filters
of 2, 3 and 4 bytes slide over byte embeddings, each filter's largest response
in a window is one feature, and a softmax over them gives the languages. A
document's probabilities are the mean over its windows.

For inference, embedding and filters fold into tables: a filter of width w
costs one row lookup per pair of bytes instead of a matrix product. A-Z are
folded to a-z first.

Training uses a bounded sample (``per_lang`` documents of each of the
``max_langs`` most frequent languages, ``per_doc`` windows each); scoring reads
every byte of every text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.llm.common import fresh, text_or_empty
from reviewlake.llm.words import string_slices

WINDOW, WIDTHS, FILTERS, DIM = 256, (2, 3, 4), 16, 8
PER_LANG, PER_DOC, MAX_LANGS, EPOCHS, BATCH = 600, 4, 64, 4, 64
UNDETERMINED = "und"
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20


class ByteCNN:
    """Multi-width byte filters, max pooling, softmax."""

    def __init__(self, classes: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.classes = classes
        f32 = lambda *shape, s: (rng.standard_normal(shape) * s).astype(np.float32)
        self.p = {"embed": f32(256, DIM, s=0.5), "dense": f32(len(WIDTHS) * FILTERS, len(classes), s=0.1),
                  "out": np.zeros(len(classes), np.float32)}
        for w in WIDTHS:
            self.p[f"w{w}"] = f32(w * DIM, FILTERS, s=(2 / (w * DIM)) ** 0.5)
            self.p[f"b{w}"] = np.zeros(FILTERS, np.float32)

    def _step(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross entropy on windows x with classes y."""
        p, rows = self.p, np.arange(len(x))[:, None]
        emb = p["embed"][x]
        feats, seen = [], []
        for w in WIDTHS:
            n = x.shape[1] - w + 1
            patch = np.concatenate([emb[:, j:j + n] for j in range(w)], axis=2)
            conv = patch @ p[f"w{w}"] + p[f"b{w}"]
            at = conv.argmax(axis=1)
            feats.append(np.maximum(np.take_along_axis(conv, at[:, None], 1)[:, 0], 0))
            seen.append((at, patch[rows, at]))
        h = np.concatenate(feats, axis=1)
        prob = softmax(h @ p["dense"] + p["out"])
        prob[np.arange(len(y)), y] -= 1
        prob /= len(y)
        grad = {"dense": h.T @ prob, "out": prob.sum(0), "embed": np.zeros_like(p["embed"])}
        back = (prob @ p["dense"].T) * (h > 0)
        for i, w in enumerate(WIDTHS):
            d = back[:, i * FILTERS:(i + 1) * FILTERS]
            at, patch = seen[i]
            grad[f"w{w}"] = np.einsum("bf,bfk->kf", d, patch)
            grad[f"b{w}"] = d.sum(0)
            to = (d[:, :, None] * p[f"w{w}"].T[None]).reshape(len(x), FILTERS, w, DIM)
            for j in range(w):
                np.add.at(grad["embed"], x[rows, at + j], to[:, :, j])
        return grad

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> ByteCNN:
        """Adam over shuffled batches."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(u) for k, u in self.p.items()}
        t = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for lo in range(0, len(x), BATCH):
                at = order[lo:lo + BATCH]
                t += 1
                for k, g in self._step(x[at], y[at]).items():
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.001 * (g * g - v[k])
                    self.p[k] -= 0.004 * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
        return self

    def tables(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """Per width: the response to bytes as rows of (pair table, second table)."""
        out = []
        for w in WIDTHS:
            one = [self.p["embed"] @ self.p[f"w{w}"][j * DIM:(j + 1) * DIM] for j in range(w)]
            pair = lambda a, b: (a[:, None] + b[None]).reshape(65536, FILTERS)
            second = {2: None, 3: one[-1], 4: pair(one[2], one[3]) if w == 4 else None}[w]
            out.append((w, pair(one[0] + self.p[f"b{w}"], one[1]), second))
        return out


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def window_starts(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, start) of the windows that tile texts of the given sizes; one for an empty text."""
    n = np.maximum(-(-size // WINDOW), 1)
    text = np.repeat(np.arange(len(size)), n)
    i = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    return text, np.minimum(i * WINDOW, np.maximum(size[text] - WINDOW, 0))


def _predict(model: ByteCNN, text_col: str, open_col: str, new: list[str]) -> Callable:
    def probabilities(tables, data, offsets):
        size = np.diff(offsets)
        text, start = window_starts(size)
        total = np.zeros((len(size), len(model.classes)))
        padded = _FOLD[np.concatenate((data, np.zeros(WINDOW, np.uint8)))]
        for lo in range(0, len(text), 256):
            t, s = text[lo:lo + 256], start[lo:lo + 256]
            x = padded[(offsets[t] + s)[:, None] + np.arange(WINDOW)]
            short = size[t] < WINDOW
            if short.any():
                x[short] = np.where(np.arange(WINDOW) < size[t][short][:, None], x[short], 0)
            pairs = (x[:, :-1].astype(np.intp) << 8) | x[:, 1:]
            feats = []
            for w, first, second in tables:
                n = WINDOW - w + 1
                r = first[pairs[:, :n]]
                if w == 3:
                    r += second[x[:, 2:]]
                elif w == 4:
                    r += second[pairs[:, 2:]]
                feats.append(np.maximum(r.max(axis=1), 0))
            z = np.concatenate(feats, axis=1) @ model.p["dense"] + model.p["out"]
            np.add.at(total, t, softmax(z))
        return total / np.bincount(text, minlength=len(size))[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, names = model.tables(), np.array(model.classes, object)
        for b in batches:
            parts = [probabilities(tables, data, off) for _, _, data, off in string_slices(b.column(text_col))]
            prob = np.concatenate(parts) if parts else np.zeros((0, len(names)))
            best, is_open = prob.argmax(axis=1), b.column(open_col).to_numpy(zero_copy_only=False).astype(bool)
            lang = np.where(is_open, names[best], UNDETERMINED)
            score = np.where(is_open, prob.max(axis=1), 0.0)
            same = [c for c in b.schema.names if c != open_col]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in same] + [pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=same + new)
    return run


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", *,
          per_lang: int = PER_LANG, per_doc: int = PER_DOC, max_langs: int = MAX_LANGS,
          epochs: int = EPOCHS) -> ByteCNN | None:
    """Fit on a hashed sample of labelled rows; None without any labelled text.

    Rows of null language or without a letter teach nothing. Each language's
    sample is chosen by a hash of id and text, so it doesn't depend on
    partitions; rows that repeat both count once. Null and repeated ids draw by
    their texts, and no language takes another's place.
    """
    text, lang = text_or_empty(text_col), F.col(f"`{lang_col}`").cast("string")
    draw = F.shiftrightunsigned(F.xxhash64(F.col(f"`{id_col}`").cast("string"), text), 2)
    rows = docs.where(lang.isNotNull() & text.rlike(r"\p{L}"))
    counts = (rows.select(lang.alias("lang"), draw.alias("draw")).distinct().groupBy("lang").count()
              .orderBy(F.desc("count"), "lang").limit(max_langs).collect())
    if not counts:
        return None
    share = F.lit(0)
    for r in counts:
        share = F.when(lang == r["lang"], F.lit(int(min(1.0, 1.2 * per_lang / r["count"]) * (1 << 62)))).otherwise(share)
    # per_doc windows spread over the text; a window's bytes fit in as many characters
    n = F.length(text)
    starts = [F.greatest(F.lit(1), ((n - WINDOW) * i / max(per_doc - 1, 1)).cast("int") + 1) for i in range(per_doc)]
    parts = F.array_distinct(F.array(*[F.substring(text, s, F.lit(WINDOW)) for s in starts]))
    sample = (rows.where(draw < share).groupBy(draw.alias("draw"), lang.alias("lang")).agg(F.min(parts).alias("parts"))
              .collect())
    sample.sort(key=lambda r: (r["draw"], r["lang"]))
    classes = sorted({r["lang"] for r in sample})
    if not classes:
        return None
    x, y, left = [], [], dict.fromkeys(classes, per_lang)
    for r in sample:
        if left[r["lang"]] <= 0:
            continue
        left[r["lang"]] -= 1
        for part in r["parts"]:
            raw = part.encode()[:WINDOW]
            x.append(_FOLD[np.frombuffer(raw.ljust(WINDOW, b"\0"), np.uint8)])
            y.append(classes.index(r["lang"]))
    return ByteCNN(classes).fit(np.array(x), np.array(y), epochs)


def identify(docs: DataFrame, model: ByteCNN | None, text_col: str = "text") -> DataFrame:
    """``docs`` plus lang_pred and score (0 to 1).

    Null, empty and letterless texts are ``und`` with score 0, and so is
    everything without a model. Columns named like the new ones are replaced.
    """
    new = ["lang_pred", "score"]
    base = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in new])
    (is_open,) = fresh(base, "open")
    if model is None:
        return base.withColumns({new[0]: F.lit(UNDETERMINED), new[1]: F.lit(0.0)})
    schema = T.StructType([*base.schema.fields, T.StructField(new[0], T.StringType()), T.StructField(new[1], T.DoubleType())])
    return (base.withColumn(is_open, text_or_empty(text_col).rlike(r"\p{L}"))
            .mapInArrow(_predict(model, text_col, is_open, new), schema))
