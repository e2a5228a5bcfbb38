"""Plain-Python versions of the operators' definitions, for small tables."""

import collections
import hashlib
import math
import re
import zlib

_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def words(text) -> list[bytes]:
    return (text or "").encode().split()   # bytes.split(): space and U+0009..U+000D


def normalised(text) -> str:
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def substring_dedup(rows, window=35):
    """(n_words, n_removed, kept) for (id, text) rows, in order."""
    ws = [words(t) for _, t in rows]
    seen = collections.Counter(tuple(w[i:i + window]) for w in ws for i in range(len(w) - window + 1))
    out = []
    for w in ws:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


def shingles(text, k=5):
    w = words(text)
    return [tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []


def lcs(a, b) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        left = 0
        for j, y in enumerate(b):
            left, row[j + 1] = row[j + 1], (left + 1 if x == y else max(row[j + 1], row[j]))
    return row[-1]


def near_classes(rows):
    """id -> smallest id of its class, by all pairs of (id, text) rows."""
    s = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in s}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(s)
    sets = {i: collections.Counter(s[i]) for i in ids}
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = s[a], s[b]
            total = len(x) + len(y)
            alike = x == y
            if not alike and 9 * min(len(x), len(y)) >= 4 * total and 9 * sum((sets[a] & sets[b]).values()) >= 4 * total:
                alike = 9 * lcs(x, y) >= 4 * total
            if alike:
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {i: root(i) for i in ids}


def paragraphs(text, long=1000):
    out = []
    for line in re.split(r"\n+", text):
        out += re.split(r"(?<=[.!?;])\s+", line) if len(line) > long else [line]
    return set(collections.Counter(x for x in out if x.strip(" ")).items())


def likeness(a, b) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


class Bigrams:
    """Interpolated modified Kneser-Ney as in the textbook."""

    def __init__(self, texts):
        toks = [self.tokens(t) for t in texts]
        self.c = collections.Counter(x for t in toks for x in t)
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.bi = collections.Counter(p for t in toks for p in zip([0, *t], t))
        self.nc = collections.Counter(w for _, w in self.bi)
        self.ctx = collections.defaultdict(lambda: [0, 0, 0, 0])
        for (u, _), n in self.bi.items():
            self.ctx[u][0] += n
            self.ctx[u][min(n, 3)] += 1
        self.d, self.d2 = self._discounts(self.bi), self._discounts(self.nc)

    @staticmethod
    def tokens(text):
        return [*(text or "").encode().translate(_FOLD).split(), None]

    @staticmethod
    def _discounts(counter):
        n = collections.Counter(counter.values())
        y = n[1] / (n[1] + 2 * n[2])
        return [0, 1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]]

    def p(self, u, w):
        types = len(self.bi)
        low = max(self.nc[w] - self.d2[min(self.nc[w], 3)], 0) / types
        low += sum(self.d2[min(n, 3)] for n in self.nc.values()) / types / (self.v + 1)
        if u not in self.ctx:
            return low
        x, n = self.ctx[u], self.bi[u, w]
        return max(n - self.d[min(n, 3)], 0) / x[0] + sum(self.d[i] * x[i] for i in (1, 2, 3)) / x[0] * low

    def score(self, text):
        """(tokens, known, base, score)."""
        t = self.tokens(text)
        base = sum(math.log10((self.c[x] + .1) / (self.n + .1 * (self.v + 1))) for x in t)
        return len(t), sum(self.c[x] > 0 for x in t), base, sum(math.log10(self.p(u, w)) for u, w in zip([0, *t], t))


def pieces(ids: list[int], length=1024):
    """(start, piece ids): cut from the end, the first piece may be shorter."""
    first = (len(ids) - 1) % length + 1
    cut = [0, *range(first, len(ids) + 1, length)]
    return [(a, ids[a:b]) for a, b in zip(cut[:-1], cut[1:])]


def best_fit(sizes, length=1024) -> int:
    """Sequences of best-fit decreasing, close to the fewest there can be."""
    gaps, n = collections.Counter(), 0
    for s in sorted(sizes, reverse=True):
        gap = next((g for g in range(s, length + 1) if gaps[g]), None)
        if gap is None:
            n, gap = n + 1, length
        else:
            gaps[gap] -= 1
        gaps[gap - s] += 1
    return n


def crc_mod(doc_id, n) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def fill_in_middle(doc_id, text, seed=1):
    """(n, form, prefix_chars, middle_chars, output)."""
    t = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", t)
    h = sha(f"{seed}:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, t
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def vector_codes(rows, parts=4, entries=256, rounds=4):
    """{id: (code, error)} and all final components, for (id, vector) rows with distinct ids, by plain search."""
    rows = sorted((i, [math.floor(1024 * x) for x in v]) for i, v in rows
                  if v and all(x is not None and math.isfinite(x) for x in v))
    if not rows:
        return {}, []
    w = len(rows[0][1]) // parts
    cut = [[v[p * w:p * w + w] for p in range(parts)] for _, v in rows]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            got = collections.defaultdict(list)
            for c in cut:
                got[nearest(p, c[p])[1]].append(c[p])
            for k, xs in got.items():
                books[p][k] = [sum(col) // len(xs) for col in zip(*xs)]
    out = {}
    for (i, _), c in zip(rows, cut):
        best = [nearest(p, c[p]) for p in range(parts)]
        out[i] = "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best)
    return out, [x for b in books for e in b for x in e]
