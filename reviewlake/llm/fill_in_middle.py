"""Fill-in-the-middle transformation of whole texts, by Arrow compute kernels.

Each batch of texts goes through one kernel chain: texts split into lists of
units (a run of letters A-Z, or one other character), the lists flattened with
their parent row, ordinals in the row, three filters by role (prefix, middle,
suffix), the lists rebuilt from the roles' counts, and the pieces joined around
the marks. No Python loop touches a text or a unit.

Units are cut at bytes: the separator 0xFF never occurs in UTF-8, so no text
needs escaping. Where the cuts fall and which form a text takes are functions
of the document id, computed by the engine's own hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.llm.common import text_or_empty

# The marks of the three pieces, and the shares in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FIM_PERCENT, SPM_PERCENT, SEED = 90, 20, 1
# a run of letters, another ASCII character, a longer UTF-8 character, a stray byte
_UNIT = rb"[A-Za-z]+|[\x00-\x7F]|[\xC2-\xF4][\x80-\xBF]+|[\x80-\xFF]"
_CUT = b"\xff"
_CHUNK = 4 << 20                 # bytes of text that go through the chain at once; one text at least


def _mod(a: pa.Array, b: pa.Array) -> pa.Array:
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))


def _join(kept: pa.Array, counts: pa.Array) -> pa.Array:
    """Units of one role, in order, joined per row; ``counts`` of them in each row."""
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(counts).cast(pa.int32())])
    return pc.binary_join(pa.ListArray.from_arrays(offsets, kept), pa.scalar(b"", pa.large_binary()))


def _transform(text: pa.Array, h1: pa.Array, h2: pa.Array, form: pa.Array) -> dict[str, pa.Array]:
    """n, prefix_chars, middle_chars, output of one chunk of texts (large_binary)."""
    units = pc.split_pattern(pc.replace_substring_regex(text, pattern=_UNIT, replacement=b"\\0" + _CUT), _CUT)
    flat, row = pc.list_flatten(units), pc.list_parent_indices(units)
    ordinal = pc.subtract(pa.array(np.arange(len(flat), dtype=np.int64)), pc.take(units.offsets, row).cast(pa.int64()))
    # every unit is followed by a cut: the last element of a row is empty and falls to the suffix
    whole = pc.list_value_length(units).cast(pa.int64())
    a, b = _mod(h1, whole), _mod(h2, whole)
    first, second = pc.min_element_wise(a, b), pc.max_element_wise(a, b)
    in_prefix, in_suffix = pc.less(ordinal, pc.take(first, row)), pc.greater_equal(ordinal, pc.take(second, row))
    in_middle = pc.invert(pc.or_(in_prefix, in_suffix))
    prefix = _join(flat.filter(in_prefix), first)
    middle = _join(flat.filter(in_middle), pc.subtract(second, first))
    suffix = _join(flat.filter(in_suffix), pc.subtract(whole, second))
    p, s, m = (pa.scalar(x.encode(), pa.large_binary()) for x in (PREFIX, SUFFIX, MIDDLE))
    none = pa.scalar(b"", pa.large_binary())
    psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, none)
    spm = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, none)
    plain = pc.equal(form, "plain")
    null = pa.scalar(None, pa.int64())
    size = lambda x: pc.if_else(plain, null, pc.utf8_length(x.cast(pa.large_string())).cast(pa.int64()))
    return {"n": pc.subtract(whole, 1), "prefix_chars": size(prefix), "middle_chars": size(middle),
            "output": pc.if_else(plain, text, pc.if_else(pc.equal(form, "psm"), psm, spm))}


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``_CHUNK`` bytes of text each."""
    size = np.maximum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False), 1)
    group = (np.cumsum(size) - size) // _CHUNK
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def _run(id_name: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in _chunks(batch):
                text = b.column("text").cast(pa.large_binary())
                out = _transform(text, b.column("h1"), b.column("h2"), b.column("form"))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), out["n"], b.column("form"), out["prefix_chars"], out["middle_chars"],
                     out["output"].cast(pa.string())],
                    names=[id_name, "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, seed: int = SEED,
                   fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """One row per document: id, n, form, prefix_chars, middle_chars, output.

    ``n`` counts the units of the text. Four numbers hashed from (seed, id) give
    the two cuts and the form: ``plain`` (the text as it is), ``psm`` or
    ``spm``. Empty texts, null ones (empty) and those that hold a mark are
    always plain; the sizes of the pieces are then null. Rows that share an id
    share the numbers; a null id counts as the empty string. The result has
    these six columns only, whatever else ``docs`` has. No shuffle: each batch
    is transformed where it is read.
    """
    text, key = text_or_empty(text_col), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), key), 256)
    h = [F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    form = (F.when((F.col("text") == "") | marked | (h[2] % 100 >= fim_percent), "plain")
            .when(h[3] % 100 < spm_percent, "spm").otherwise("psm"))
    rows = (docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"), digest.alias("digest"))
            .select("id", "text", h[0].alias("h1"), h[1].alias("h2"), form.alias("form")))
    longs = [T.StructField(c, T.LongType()) for c in ("n", "prefix_chars", "middle_chars")]
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), longs[0], T.StructField("form", T.StringType()),
                           *longs[1:], T.StructField("output", T.StringType())])
    return rows.mapInArrow(_run(id_col), schema)


def restore(output: Column, form: Column) -> Column:
    """The text that an output of this form was made from.

    No piece holds a mark and no mark starts inside another, so the three marks
    of a transformed text are the only ones.
    """
    part = F.split(output, "<[PSM]>", -1)
    return (F.when(form == "psm", F.concat(part[1], part[3], part[2]))
            .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output))
