"""Near-duplicates by order MinHash, verified by banded alignment.

A document is its sequence of five-word shingles, repeated ones labelled by
occurrence. Each of ``SKETCHES`` sketches takes the ``PER_SKETCH`` shingles of
smallest hash and keeps them in text order, so that two documents share a
sketch only where they agree in content and order. Two documents are linked
when an alignment of their shingle sequences matches L of them with
L / (n + m - L) >= 0.8. Such an alignment stays within (n + m) / 9 of the
diagonal, so the band loses nothing; and documents that alike miss all 16
sketches about once in 100,000 pairs.

Documents with the same words are one node, represented by the smallest id.
Candidates are never all pairs of a group: buckets of up to ``SMALL`` nodes
are compared within (a constant per node); a larger one compares every node
with its hub, the node that meets most others in the large buckets, and is
dealt again by two neighbouring sketches at once, whose buckets are treated
alike. Classes are the connected components of the links.

Then every large bucket that still holds several classes compares all its
pairs across classes: first by parities of hashed shingles, which differ in at
most as many places as the shingle sets do, so that no pair >= 0.8 is ruled
out; what they leave is verified like any other pair. A round takes each
node's nearest, joins classes and widens, until a round has left nothing out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import add_row_key, fresh, one_each, shared_path, text_or_empty, totals
from reviewlake.llm.words import BASE, BASE2, U64, Words, _GAMMA, mix, numbers, string_slices, windows

SHINGLE, SKETCHES, PER_SKETCH, SMALL = 5, 16, 3, 16
# Nodes of a block of a large bucket; the nearest that a first round takes of a block; bits of parities.
BLOCK, NEAREST, LEAST_BITS, MOST_BITS = 512, 16, 64, 1 << 16
_TOP = U64(0xFFFFFFFFFFFFFFFF)


def _shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets by document); a document of fewer than k words is one shingle, an empty one none."""
    h = words.hashes()
    g = windows(h, k)
    whole = np.arange(len(g)) + k <= words.doc_end[:len(g)]
    size = np.diff(words.first)
    count = np.where(size >= k, size - k + 1, (size > 0).astype(np.int64))
    offsets = np.concatenate(([0], np.cumsum(count)))
    out = np.zeros(int(offsets[-1]), U64)
    short = np.flatnonzero((size > 0) & (size < k))
    long_place = np.ones(len(out), bool)
    long_place[offsets[short]] = False
    out[long_place] = g[whole]
    with np.errstate(over="ignore"):
        for d in short:
            acc = U64(0)
            for x in h[words.first[d]:words.first[d + 1]]:
                acc = acc * BASE + x
            out[offsets[d]] = mix(np.array([acc + U64(size[d])]))[0]
    return out, offsets


def _by_occurrence(g: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Hashes of (shingle, how many equal ones precede it in its document)."""
    with np.errstate(over="ignore"):
        key = mix(g + doc.astype(U64) * _GAMMA)
        order = np.argsort(key, kind="stable")
        same = np.concatenate(([False], key[order][1:] == key[order][:-1]))
        at = np.arange(len(g))
        nth = np.zeros(len(g), np.int64)
        nth[order] = at - np.maximum.accumulate(np.where(same, 0, at))
        return mix(g + nth.astype(U64) * _GAMMA)


def order_sketches(e: np.ndarray, offsets: np.ndarray, sketches: int, per_sketch: int) -> np.ndarray:
    """(documents with shingles, sketches): keys of the smallest elements in text order."""
    size = np.diff(offsets)
    full = np.flatnonzero(size)
    start, size = offsets[:-1][full], size[full]
    row = np.repeat(np.arange(len(full)), size)
    out = np.zeros((len(full), sketches), U64)
    for j, seed in enumerate(numbers(101, sketches)):
        x = mix(e ^ seed)
        places = np.full((len(full), per_sketch), len(e))
        for i in range(per_sketch):
            low = np.minimum.reduceat(x, start)
            at = np.flatnonzero(x == np.repeat(low, size))
            at = at[np.concatenate(([True], row[at][1:] != row[at][:-1]))]
            there = low != _TOP
            places[there, i] = at[there]
            x[at] = _TOP
        places.sort(axis=1)
        with np.errstate(over="ignore"):
            acc = np.full(len(full), seed)
            ends = np.append(e, U64(0))
            for i in range(per_sketch):
                acc = acc * BASE + ends[places[:, i]]
            out[:, j] = mix(acc)
    return out


def parities(e: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """Per document: for each cell that its elements hash to, whether an odd number does.

    The cells are a power of two, at least twice the elements up to MOST_BITS.
    """
    size = np.diff(offsets)
    least = np.clip(2 * size, LEAST_BITS, MOST_BITS)
    bits = np.int64(1) << np.ceil(np.log2(least)).astype(np.int64)
    end = np.cumsum(bits)
    cell = (e & np.repeat(bits - 1, size).astype(U64)).astype(np.int64) + np.repeat(end - bits, size)
    odd = np.packbits((np.bincount(cell, minlength=int(end[-1])) & 1).astype(bool), bitorder="little")
    return [odd[(y - b) // 8:y // 8].tobytes() for b, y in zip(bits, end)]


def _sketch(shingle: int, sketches: int, per_sketch: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in string_slices(b.column(2)):
                words = Words(data, offsets)
                g, off = _shingles(words, shingle)
                h = words.hashes()
                same = []
                with np.errstate(over="ignore"):
                    for base in (BASE, BASE2):   # 128 bits of the word sequence
                        power = np.full(len(h) + 1, base, U64)
                        power[0] = 1
                        power = np.multiply.accumulate(power)
                        place = np.arange(len(h)) - words.doc_start
                        total = np.concatenate(([U64(0)], np.cumsum(h * power[place])))
                        same.append(mix(total[words.first[1:]] - total[words.first[:-1]] + np.diff(words.first).astype(U64)))
                keys = np.zeros((hi - lo, sketches), U64)
                has = np.diff(off) > 0
                labelled = g
                if len(g):
                    doc = np.repeat(np.arange(hi - lo), np.diff(off))
                    labelled = _by_occurrence(g, doc)
                    keys[has] = order_sketches(labelled, off, sketches, per_sketch)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(has * sketches))), pa.int32()),
                    pa.array(keys[has].reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo),
                     *[pa.array(s.view(np.int64)) for s in same], lists,
                     pa.array(np.diff(off), pa.int64()), pa.array(parities(labelled, off), pa.binary())],
                    names=["key", "crc", "d1", "d2", "sketches", "size", "odd"])
    return run


def matched(a: list, b: list, band: int) -> int:
    """Length of the longest common subsequence of a and b within the band.

    Rows of the alignment are bits of one integer: adding the matches to the
    open columns carries each match to the next free one (a zero bit is a
    matched column).
    """
    lo, hi = 0, 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    a, b = a[lo:len(a) - hi], b[lo:len(b) - hi]
    if not a or not b:
        return lo + hi
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | (1 << i)
    every, near = (1 << len(a)) - 1, (1 << (2 * band + 1)) - 1
    open_ = every
    for j, x in enumerate(b):
        hit = where.get(x, 0)
        if hit:
            shift = j - band
            hit &= near << shift if shift >= 0 else near >> -shift
            use = open_ & hit
            open_ = ((open_ + use) | (open_ - use)) & every
    return lo + hi + len(a) - open_.bit_count()


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether L / (n + m - L) >= 0.8 for the matched shingles L, in whole numbers."""
    total = len(a) + len(b)
    if 9 * min(len(a), len(b)) < 4 * total:
        return False
    # shared shingles, order aside, bound the alignment
    ua, na = np.unique(a, return_counts=True)
    ub, nb = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    if 9 * int(np.minimum(na[i], nb[j]).sum()) < 4 * total:
        return False
    return 9 * matched(a.tolist(), b.tolist(), -(-total // 9)) >= 4 * total


def _verify(shingle: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sides = []
            for name in ("text_a", "text_b"):
                rows = []
                for _, _, data, offsets in string_slices(b.column(name)):
                    g, off = _shingles(Words(data, offsets), shingle)
                    rows += [g[x:y] for x, y in zip(off[:-1], off[1:])]
                sides.append(rows)
            keep = pa.array([similar(x, y) for x, y in zip(*sides)], pa.bool_())
            yield b.select(["a", "b"]).filter(keep)
    return run


def _written(df: DataFrame, name: str) -> DataFrame:
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _pairs(members: DataFrame, small: int) -> tuple[DataFrame, DataFrame]:
    """From (bucket, node): candidate pairs (a, b), and (node, buckets) of the members of large buckets."""
    sizes = totals(members, "bucket", size=F.count(F.lit(1))).where("size > 1")
    shared = members.join(sizes, "bucket")
    lists = (shared.where(F.col("size") <= small).groupBy("bucket")
             .agg(F.sort_array(F.collect_list("node")).alias("nodes")))
    # each node with those after it: at most small * (small - 1) / 2 pairs
    within = F.flatten(F.transform("nodes", lambda x, i: F.transform(
        F.slice("nodes", i + 2, F.lit(small)), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    close = lists.select(F.explode(within).alias("p")).select("p.a", "p.b")
    # a node with its large buckets, one for each sketch at most
    large = _written(shared.where(F.col("size") > small).groupBy("node").agg(
        F.sum("size").alias("meets"), F.sort_array(F.collect_list(F.struct("nth", "bucket"))).alias("buckets")), "large")
    ranked = large.select(F.explode("buckets.bucket").alias("bucket"), F.struct((-F.col("meets")).alias("less"), "node").alias("rank"))
    hubs = totals(ranked, "bucket", best=F.min("rank")).select("bucket", F.col("best.node").alias("hub"))
    star = (ranked.select("bucket", "rank.node").join(hubs, "bucket").where(F.col("node") != F.col("hub"))
            .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")))
    return close.unionByName(star), large.select("node", "buckets")


def _folded(odd: list[bytes], bits: int) -> np.ndarray:
    """Parities of fewer cells, those of equal low bits together, as rows of 64-bit words."""
    x = np.frombuffer(b"".join(odd), U64).reshape(len(odd), -1)
    while x.shape[1] * 64 > bits:
        half = x.shape[1] // 2
        x = x[:, :half] ^ x[:, half:]
    return x


def _nearest(nearest: int) -> Callable:
    """Of a block's nodes of smaller classes: pairs with nodes of other classes that may reach 0.8.

    Each node gives its ``nearest`` nearest, with ``more`` where others are left.
    """
    def run(block: pa.Table) -> pa.Table:
        nodes = np.stack([block.column(c).to_numpy() for c in ("key", "crc")], axis=1)
        labels = np.stack([block.column(c).to_numpy() for c in ("lkey", "lcrc")], axis=1)
        size, side = block.column("size").to_numpy(), block.column("side").to_numpy()
        odd = block.column("odd").to_pylist()
        bits = np.array([8 * len(x) for x in odd])
        # (first node, second node, distance over what 0.8 allows)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for mine in np.unique(bits[side == 0]):
            # sizes that differ by more than a quarter can't reach 0.8: cells differ by a step at most
            for theirs in (mine // 2, mine, 2 * mine):
                left, right = np.flatnonzero((side == 0) & (bits == mine)), np.flatnonzero((side == 1) & (bits == theirs))
                if not len(left) or not len(right):
                    continue
                cells = min(mine, theirs)
                x, y = _folded([odd[i] for i in left], cells), _folded([odd[i] for i in right], cells)
                step = max(1, (1 << 21) // (len(right) * x.shape[1]))
                for lo in range(0, len(left), step):
                    some = left[lo:lo + step]
                    apart = np.bitwise_count(x[lo:lo + step, None] ^ y[None]).sum(axis=2, dtype=np.int64)
                    apart = np.maximum(apart, np.abs(size[some, None] - size[None, right]))
                    both = size[some, None] + size[None, right]
                    may = (9 * apart <= both) & (labels[some, None] != labels[None, right]).any(axis=2)
                    i, j = np.nonzero(may)
                    found.append((some[i], right[j], apart[i, j] / both[i, j]))
        a, b, far = (np.concatenate(f) for f in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
        order = np.lexsort((far, a))
        a, b = a[order], b[order]
        nth = np.arange(len(a)) - np.searchsorted(a, a)
        more = np.isin(a, a[nth >= nearest])
        keep = nth < nearest
        a, b, more = a[keep], b[keep], more[keep]
        return pa.table({"akey": nodes[a, 0], "acrc": nodes[a, 1], "bkey": nodes[b, 0], "bcrc": nodes[b, 1], "more": more})
    return run


def _open(large: DataFrame, labels: DataFrame) -> DataFrame:
    """From (node, buckets): (node, label, open), the buckets of several classes with their largest class and sizes."""
    named = large.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"), "buckets")
    members = named.select(F.explode("buckets").alias("bucket"), "node", "label")
    classes = totals(members, "bucket", "label", n=F.count(F.lit(1)))
    mixed = totals(classes, "bucket", most=F.max(F.struct("n", "label")), n=F.sum("n"), classes=F.count(F.lit(1))).where(
        "classes > 1").select("bucket", F.col("most.label").alias("most"), F.col("most.n").alias("most_n"), "n")
    return _written(members.join(mixed, "bucket").groupBy("node", "label").agg(
        F.collect_list(F.struct("bucket", "most", "most_n", "n")).alias("open")), "open")


def _across(open_: DataFrame, odd: DataFrame, nearest: int, block: int) -> DataFrame:
    """(a, b, more): pairs of open buckets across classes, to be verified.

    Nodes outside a bucket's largest class meet all of the bucket, dealt in
    blocks. Nodes meet their parities once, with all their buckets in one list.
    """
    full = (open_.join(odd.join(open_.select("node"), "node", "left_semi").dropDuplicates(["node"]), "node")
            .select("node", "label", "size", "odd", F.inline("open"))
            .withColumns({"rows": F.ceil((F.col("n") - F.col("most_n")) / block), "cols": F.ceil(F.col("n") / block)}))
    deal = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    columns = ["bucket", "row", "col", "side", F.col("node.key").alias("key"), F.col("node.crc").alias("crc"),
               F.col("label.key").alias("lkey"), F.col("label.crc").alias("lcrc"), "size", "odd"]
    mine = full.where(F.col("label") != F.col("most")).withColumns(
        {"row": deal("rows"), "col": every("cols"), "side": F.lit(0)}).select(*columns)
    theirs = full.withColumns({"row": every("rows"), "col": deal("cols"), "side": F.lit(1)}).select(*columns)
    near = mine.union(theirs).groupBy("bucket", "row", "col").applyInArrow(
        _nearest(nearest), "akey long, acrc long, bkey long, bcrc long, more boolean")
    a, b = F.struct(F.col("akey").alias("key"), F.col("acrc").alias("crc")), F.struct(F.col("bkey").alias("key"), F.col("bcrc").alias("crc"))
    return _written(near.groupBy(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).agg(F.max("more").alias("more")), "across")


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each connected component of links (a, b).

    Labels spread to neighbours and then jump to the label of the label;
    rounds end when none changes. Only tables of links and labels move, each
    round's written to the shared folder.
    """
    both = _written(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = _written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                      .select("node", F.least("node", "low").alias("label")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("low")))
        spread = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "low").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        after = _written(spread.join(jump, "label").select(
            "node", "was", F.least("label", "next").alias("label")), "labels")
        labels = after.select("node", "label")
        if after.where(F.col("was") != F.col("label")).isEmpty():
            return labels


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) with the classes that new links (a, b) connect made one.

    Only the classes at the links' ends are a graph here; nodes that had no
    class come in with their own.
    """
    known = labels.withColumnRenamed("label", "has")
    ends = (links.join(known.withColumnRenamed("node", "a"), "a", "left").withColumn("x", F.coalesce("has", "a")).drop("has")
            .join(known.withColumnRenamed("node", "b"), "b", "left").withColumn("y", F.coalesce("has", "b")).drop("has"))
    classes = components(_written(ends.select(F.col("x").alias("a"), F.col("y").alias("b")).where("a <> b").distinct(), "classes"))
    renamed = classes.select(F.col("node").alias("label"), F.col("label").alias("now"))
    moved = labels.join(renamed, "label", "left").select("node", F.coalesce("now", "label").alias("label"))
    fresh_ones = classes.join(labels.select("node"), "node", "left_anti").select("node", "label")
    return _written(moved.unionByName(fresh_ones), "labels")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = SHINGLE,
                 sketches: int = SKETCHES, per_sketch: int = PER_SKETCH, small: int = SMALL,
                 nearest: int = NEAREST, block: int = BLOCK) -> DataFrame:
    """``docs`` without the text, plus class_id, class_size and kept.

    ``class_id`` is the smallest id of the document's class (for rows without
    an integer id, a hash of id and text stands for it). Null and empty texts,
    and those of white space, have the same (no) words: one class. Rows that
    repeat id and text are one node, count each in class_size and share
    ``kept``. Columns that have one of the new names are replaced.
    """
    new = ["class_id", "class_size", "kept"]
    key, crc = fresh(docs, "key", "crc")
    base = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in new])
    keyed = add_row_key(base, id_col, text_col, key, crc)
    texts = keyed.select(F.col(key).alias("key"), F.col(crc).alias("crc"), text_or_empty(text_col).alias("text"))
    marks = _written(texts.mapInArrow(
        _sketch(shingle, sketches, per_sketch), "key long, crc long, d1 long, d2 long, sketches array<long>, size long, odd binary"), "sketches")
    node = F.struct("key", "crc").alias("node")
    odd = marks.select(node, "size", "odd")
    marks = marks.select(node, "d1", "d2", "sketches")
    same = marks.groupBy("d1", "d2").agg(F.min("node").alias("rep"), F.count(F.lit(1)).alias("copies"))
    reps = marks.join(same.select("d1", "d2", F.col("rep").alias("node")), ["d1", "d2", "node"]).dropDuplicates(["node"])

    members = _written(reps.select("node", F.posexplode("sketches").alias("nth", "bucket")).select("bucket", "node", "nth"), "members")
    first, large = _pairs(members, small)
    # a large bucket's nodes again, by two neighbouring sketches: found in the node's own list
    after = lambda x: F.filter("buckets", lambda y: y["nth"] == (x["nth"] + 1) % sketches)
    both = F.transform(F.filter("buckets", lambda x: F.size(after(x)) > 0), lambda x: F.struct(
        F.xxhash64(x["bucket"], F.get(after(x), F.lit(0))["bucket"]).alias("bucket"), x["nth"].alias("nth")))
    second, _ = _pairs(large.select("node", F.inline(both)).select("bucket", "node", "nth"), small)
    pairs = _written(first.unionByName(second).distinct(), "pairs")

    # One text per node, dealt by its key. A hub is in very many pairs: its text, among those of
    # the pairs' first nodes, is dealt anew by the node, so that the engine can split its pairs.
    def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
        one = texts.groupBy("key", "crc").agg(F.first("text").alias("text"))
        text_b = one.toDF("bk", "bc", "text_b")
        text_a = one.join(pairs.select("a.key", "a.crc").distinct(), ["key", "crc"], "left_semi").select(
            F.struct("key", "crc").alias("a"), F.col("text").alias("text_a"))
        named = pairs.select("a", "b", F.col("b.key").alias("bk"), F.col("b.crc").alias("bc"))
        checked = named.join(text_b, ["bk", "bc"]).drop("bk", "bc").join(text_a, "a").mapInArrow(_verify(shingle), pairs.schema)
        return _written(checked, "links")

    checked = pairs
    labels = components(verified(pairs, texts))
    # a bucket of one class stays so: each round sees what the last one left open
    open_ = _open(large.select("node", F.col("buckets.bucket").alias("buckets")), labels)
    while not open_.isEmpty():
        across = _across(open_, odd, nearest, block)
        pairs = _written(across.select("a", "b").join(checked, ["a", "b"], "left_anti"), "pairs")
        # only the texts of these pairs move
        ends = _written(pairs.select("a.key", "a.crc").union(pairs.select("b.key", "b.crc")).distinct(), "ends")
        new = verified(pairs, texts.join(ends, ["key", "crc"], "left_semi"))
        checked = checked.unionByName(pairs)
        if not new.isEmpty():
            labels = joined(labels, new)
        if across.where("more").isEmpty():
            break
        open_, nearest = _open(open_.select("node", F.col("open.bucket").alias("buckets")), labels), 16 * nearest

    classes = same.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "d1", "d2", F.coalesce("label", "rep").alias("class"), "copies")
    sizes = classes.groupBy("class").agg(F.sum("copies").alias("class_size"))
    found = (marks.select("node", "d1", "d2").distinct().join(classes.drop("copies"), ["d1", "d2"]).join(sizes, "class")
             .select(F.col("node.key").alias(key), F.col("node.crc").alias(crc), F.col("class.key").alias("class_id"),
                     F.col("class_size"), (F.col("node") == F.col("class")).alias("kept")))
    rest = [F.col(f"`{c}`") for c in keyed.columns if c.lower() != text_col.lower()]
    return keyed.select(*rest).join(found, [key, crc]).drop(key, crc)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each class of near-duplicates, and one row of those that repeat id and text."""
    key, crc = fresh(docs, "key", "crc")
    keyed = add_row_key(docs, id_col, text_col, key, crc)
    gone = near_classes(keyed.select(key, crc, id_col, text_col), id_col, text_col).where(~F.col("kept")).select(key, crc)
    left = keyed.join(gone, [key, crc], "left_anti")
    return one_each(left, keyed.select(key, crc), key, crc).select(*docs.columns)
