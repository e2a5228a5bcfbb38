"""Document fingerprints: invertible Bloom lookup sketches, column functions only.

A text's elements are its paragraphs, long ones cut at sentence ends, each
hashed with the number of times it occurs. A sketch has 24 cells in three
groups; an element goes to one cell of each group and adds (1, digest, check)
there - a sum and two exclusive ors. Subtracting two sketches cancels what
they share, and peeling recovers the digests that differ: a cell of count 1 or
-1 whose check fits holds one digest, which is taken out of its other cells,
until all cells are empty.

The fingerprint is one sketch of the whole text. To compare two texts, their
elements go by digest bits into as many sketches as the sizes call for; where
peeling fails, that part alone is retried with four times the cells, and what
``LEVELS`` retries leave (digests that agree in all bits used) is compared
directly. Nothing depends on how often a paragraph occurs elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from reviewlake.llm.common import fresh, text_or_empty

GROUPS, PER_GROUP, LOAD, LEVELS = 3, 8, 10, 6
LONG_PARAGRAPH = 1000
_CELL = "struct<n:int,key:bigint,check:bigint>"
_DIFF = "struct<x:array<bigint>,y:array<bigint>,a:int,b:int>"


def elements(text: Column) -> Column:
    """Digests of (paragraph, times it occurs), distinct; white space alone is no paragraph."""
    lines = F.split(text, r"\n+")
    cut = F.flatten(F.transform(lines, lambda x: F.when(
        F.length(x) > LONG_PARAGRAPH, F.split(x, r"(?<=[.!?;])\s+")).otherwise(F.array(x))))
    hashed = F.array_sort(F.transform(F.filter(cut, lambda x: F.length(F.trim(x)) > 0), lambda x: F.xxhash64(x)))
    # runs of equal hashes, by their starts: (hash, length) without counting each one anew
    return F.transform(F.array(hashed), _runs)[0]


def _runs(s: Column) -> Column:
    n = F.size(s)
    starts = F.filter(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")),
                      lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
    ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))), F.array(n))
    return F.zip_with(starts, F.slice(ends, F.lit(1), F.size(starts)), lambda i, j: F.xxhash64(F.get(s, i), j - i))


def _spec() -> Column:
    """The cells: (shift of the digest, value of its three bits there)."""
    return F.array(*[F.struct(F.lit(3 * g).alias("shift"), F.lit(v).cast("long").alias("bits"))
                     for g in range(GROUPS) for v in range(PER_GROUP)])


def _in_cell(digest: Column, cell: Column) -> Column:
    # 2 ** shift divides exactly what the other bits leave: a shift by a column
    return F.call_function("shiftright", digest, cell["shift"]).bitwiseAND(F.lit(PER_GROUP - 1).cast("long")) == cell["bits"]


def sketch(digests: Column) -> Column:
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("check"))
    return F.transform(_spec(), lambda cell: F.aggregate(
        F.filter(digests, lambda d: _in_cell(d, cell)), zero,
        lambda acc, d: F.struct((acc["n"] + 1).alias("n"), acc["key"].bitwiseXOR(d).alias("key"),
                                acc["check"].bitwiseXOR(F.xxhash64(d)).alias("check"))))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct(
        (x["n"] - y["n"]).alias("n"), x["key"].bitwiseXOR(y["key"]).alias("key"),
        x["check"].bitwiseXOR(y["check"]).alias("check")))


def peel(cells: Column) -> Column:
    """struct(ok, a, b): whether all cells empty, and how many digests only each side has."""
    kind = f"struct<cells:array<{_CELL}>,a:int,b:int,on:boolean>"

    def step(acc: Column, _: Column) -> Column:
        pure = F.array_distinct(F.transform(
            F.filter(acc["cells"], lambda c: (F.abs(c["n"]) == 1) & (F.xxhash64(c["key"]) == c["check"])),
            lambda c: F.struct(c["n"].alias("n"), c["key"].alias("key"))))
        return F.when(~acc["on"], acc).otherwise(F.transform(F.array(pure), lambda p: F.when(
            F.size(p) == 0, F.struct(acc["cells"].alias("cells"), acc["a"].alias("a"), acc["b"].alias("b"), F.lit(False).alias("on")),
        ).otherwise(F.struct(
            F.zip_with(acc["cells"], _spec(), lambda c, at: F.aggregate(
                F.filter(p, lambda q: _in_cell(q["key"], at)), c,
                lambda c2, q: F.struct((c2["n"] - q["n"]).alias("n"), c2["key"].bitwiseXOR(q["key"]).alias("key"),
                                       c2["check"].bitwiseXOR(F.xxhash64(q["key"])).alias("check")))).alias("cells"),
            (acc["a"] + F.size(F.filter(p, lambda q: q["n"] == 1))).alias("a"),
            (acc["b"] + F.size(F.filter(p, lambda q: q["n"] == -1))).alias("b"), F.lit(True).alias("on"))))[0])

    zero = F.struct(cells.alias("cells"), F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit(True).alias("on")).cast(kind)
    rounds = F.sequence(F.lit(1), F.lit(GROUPS * PER_GROUP))
    return F.aggregate(rounds, zero, step, lambda acc: F.struct(
        F.forall(acc["cells"], lambda c: (c["n"] == 0) & (c["key"] == 0) & (c["check"] == 0)).alias("ok"),
        acc["a"].alias("a"), acc["b"].alias("b")))


def _parts(x: Column, y: Column, n: Column) -> Column:
    """x and y dealt by two ranges of digest bits into n parts or a few more, in two steps."""
    def pick(part: Column, i: Column, shift: int, side: Column) -> Column:
        keep = lambda d: F.pmod(F.shiftrightunsigned(d, shift), side) == i
        return F.struct(F.filter(part["x"], keep).alias("x"), F.filter(part["y"], keep).alias("y"))
    coarse = F.ceil(F.sqrt(n)).cast("long")
    fine = F.ceil(n / coarse).cast("long")
    zero = F.lit(0).cast("long")
    whole = F.struct(x.alias("x"), y.alias("y"))
    some = F.transform(F.sequence(zero, coarse - 1), lambda i: pick(whole, i, 9, coarse))
    return F.flatten(F.transform(some, lambda part: F.transform(
        F.sequence(zero, fine - 1), lambda i: pick(part, i, 36, fine))))


def difference(x: Column, y: Column) -> Column:
    """struct(a, b): how many elements only x, only y has, by sketches that are retried larger."""
    first = F.greatest(F.lit(1.0), F.ceil((F.size(x) + F.size(y)) / F.lit(float(LOAD))))

    def step(acc: Column, level: Column) -> Column:
        tried = F.transform(_parts(acc["x"], acc["y"], first * F.pow(F.lit(4.0), level)), lambda p: F.struct(
            p.alias("p"), F.when(p["x"] == p["y"], same).otherwise(
                peel(subtract(sketch(p["x"]), sketch(p["y"])))).alias("r")))
        done = F.size(acc["x"]) + F.size(acc["y"]) == 0
        return F.when(done, acc).otherwise(F.transform(F.array(tried), lambda t: F.struct(
            F.flatten(F.transform(F.filter(t, lambda s: ~s["r"]["ok"]), lambda s: s["p"]["x"])).alias("x"),
            F.flatten(F.transform(F.filter(t, lambda s: ~s["r"]["ok"]), lambda s: s["p"]["y"])).alias("y"),
            F.aggregate(t, acc["a"], lambda n, s: n + F.when(s["r"]["ok"], s["r"]["a"]).otherwise(0)).alias("a"),
            F.aggregate(t, acc["b"], lambda n, s: n + F.when(s["r"]["ok"], s["r"]["b"]).otherwise(0)).alias("b")))[0])

    same = F.struct(F.lit(True).alias("ok"), F.lit(0).alias("a"), F.lit(0).alias("b"))
    zero = F.struct(x.alias("x"), y.alias("y"), F.lit(0).alias("a"), F.lit(0).alias("b")).cast(_DIFF)
    return F.aggregate(F.sequence(F.lit(0), F.lit(LEVELS)), zero, step, lambda acc: F.struct(
        (acc["a"] + F.size(F.array_except(acc["x"], acc["y"]))).alias("a"),
        (acc["b"] + F.size(F.array_except(acc["y"], acc["x"]))).alias("b")))


def likeness(x: Column, y: Column) -> Column:
    """Shared elements over all elements, 0 to 1; 1 for two texts without any."""
    return F.transform(F.array(difference(x, y)), lambda d: F.when(
        F.size(x) + d["b"] == 0, F.lit(1.0)).otherwise((F.size(x) - d["a"]) / (F.size(x) + d["b"])))[0]


def as_string(cells: Column) -> Column:
    return F.array_join(F.transform(cells, lambda c: F.concat_ws(":", c["n"].cast("string"), F.hex(c["key"]), F.hex(c["check"]))), " ")


def _successors(keys: DataFrame, name: str, bits: int = 16, level: int = 0) -> DataFrame:
    """(key, next): the next larger of some distinct longs; the smallest after the largest.

    Keys are ordered inside groups of equal high bits, the groups by the same
    function: at most 2**bits keys, or the 256 groups of the top, meet in a task.
    """
    if level == 3:
        w = W.orderBy(name)
        return keys.select(name, F.coalesce(F.lead(name).over(w), F.min(name).over(w)).alias("next"))
    up = f"{name}_"
    rows = keys.withColumn(up, F.shiftright(name, bits))
    groups = rows.groupBy(up).agg(F.min(name).alias("low"))
    after = _successors(groups.select(up), up, bits, level + 1)
    low = groups.select(F.col(up).alias("next"), "low").join(after, "next").select(up, "low")
    rows = rows.withColumn("inside", F.lead(name).over(W.partitionBy(up).orderBy(name)))
    return rows.join(low, up).select(name, F.coalesce("inside", "low").alias("next"))


def with_next_text(docs: DataFrame, id_col: str, text_col: str, next_col: str, *, bucket_bits: int = 8) -> DataFrame:
    """(id, text, text of the next larger id); the smallest id follows the largest.

    Rows of one id are one place, whose text is the smallest of theirs; a null
    id is smaller than any other. Each text is shuffled once, to its bucket of
    2**bucket_bits consecutive ids; beyond that only each bucket's first text.
    Only place, bucket and text cross that exchange, so both readers share it.
    """
    kind = docs.schema[id_col].dataType
    if not isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        raise TypeError(f"{id_col} must be an integer column")
    # F.lit can't hold the smallest long; an id equal to this one shares the null place
    null_place = F.lit(-(2 ** 63) + 1)
    ids = F.coalesce(F.col(f"`{id_col}`").cast("long"), null_place)
    rows = docs.select(ids.alias("place"), F.shiftright(ids, bucket_bits).alias("bucket"), text_or_empty(text_col).alias("text"))
    rows = rows.repartition("bucket")      # all windows below, by place too, keep to it
    one = W.partitionBy("bucket", "place").orderBy("text")
    larger = W.partitionBy("bucket").orderBy(F.col("place").desc()).rangeBetween(W.unboundedPreceding, -1)
    rows = (rows.withColumn("rep", F.when(F.row_number().over(one) == 1, F.col("text")))
            .withColumn("low", F.min("place").over(W.partitionBy("bucket")))
            .withColumn("inside", F.last("rep", ignorenulls=True).over(larger)))
    buckets = docs.select(F.shiftright(ids, bucket_bits).alias("b")).distinct()
    heads = rows.where(F.col("rep").isNotNull() & (F.col("place") == F.col("low"))).select(
        F.col("bucket").alias("next"), F.col("rep").alias("first"))
    after = heads.join(_successors(buckets, "b"), "next").select(F.col("b").alias("bucket"), "first")
    return rows.join(after, "bucket", "left").select(
        F.when(F.col("place") != null_place, F.col("place")).cast(kind).alias(id_col),
        F.col("text").alias(text_col), F.coalesce("inside", "first").alias(next_col))


def compare_versions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of an edited version of it, and their likeness.

    The edited text has its last floor(n/2) code points replaced by the first
    as many (or all) of the next document. Returns id, text (null is empty),
    n_chars, edited_text, fingerprint, edited_fingerprint, near_edited and
    near_next of every row; other columns of ``docs`` are not carried, so none
    can clash. An empty text's sketch is empty. See ``with_next_text`` for
    repeated and null ids.
    """
    nxt, a, b, c = fresh(docs, "next", "a", "b", "c")
    rows = with_next_text(docs, id_col, text_col, nxt)
    text = F.col(f"`{text_col}`")
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    rows = rows.select(
        "*", n.cast("long").alias("n_chars"),
        F.concat(F.substring(text, F.lit(1), n - half), F.substring(nxt, F.lit(1), half)).alias("edited_text"))
    rows = rows.withColumns({a: elements(text), b: elements(F.col("edited_text")), c: elements(F.col(nxt))})
    return rows.select(
        f"`{id_col}`", f"`{text_col}`", "n_chars", "edited_text",
        as_string(sketch(F.col(a))).alias("fingerprint"), as_string(sketch(F.col(b))).alias("edited_fingerprint"),
        likeness(F.col(a), F.col(b)).alias("near_edited"), likeness(F.col(a), F.col(c)).alias("near_next"))
