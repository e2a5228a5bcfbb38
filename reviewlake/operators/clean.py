"""Projections, parsing and validity predicates (section 2.3).

All of this is row-local (no shuffle) except ``seq_id``, which needs one tiny
aggregate of per-partition row counts. Untrusted input goes through ``try_*``
functions, so a bad value becomes a rejected row with a reason instead of an
ANSI error that kills the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.functions.exprs import strip_py
from reviewlake.schemas import REVIEW_SCHEMA, SENTIMENTS

CORRUPT_COL = "_corrupt_record"
_PARSE_SCHEMA = T.StructType(REVIEW_SCHEMA.fields + [T.StructField(CORRUPT_COL, T.StringType())])

# The producer's event timestamp format (ISO-8601 with offset).
ISO_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


# --------------------------------------------------------------------------- ingest

def _try_int(c: Column) -> Column:
    """String -> int the way ``int(float-or-int)`` behaves: '7', '7.0' -> 7."""
    s = F.trim(c.cast("string"))
    return F.coalesce(s.try_cast("int"), s.try_cast("double").try_cast("int"))


def build_event(raw: DataFrame, event_type: str = "review", id_col: str = "event_id") -> DataFrame:
    """Raw CSV row -> 9-field event plus ``reject_reason`` (null when valid).

    sentiment is ``positive`` iff score = 1, else ``negative`` (0 too); missing
    votes -> 0; app name and text are stripped of all Unicode whitespace and
    missing ones become ``""``; the timestamp is the wall clock in ISO-8601.
    Rows lacking an integer app id or score are kept with a reason (the
    reference producer would stop on them). ``raw`` must already carry
    ``id_col`` (see ``seq_id``).
    """
    score = _try_int(F.col("review_score"))
    app_id = _try_int(F.col("app_id"))
    votes = _try_int(F.col("review_votes"))
    reason = (F.when(app_id.isNull(), F.lit("invalid_app_id"))
              .when(score.isNull(), F.lit("invalid_review_score")))
    return raw.select(
        F.col(id_col).cast("long").alias("event_id"),
        F.lit(event_type).alias("event_type"),
        F.date_format(F.current_timestamp(), ISO_TS_FORMAT).alias("timestamp"),
        app_id.alias("app_id"),
        F.coalesce(strip_py(F.col("app_name")), F.lit("")).alias("app_name"),
        F.coalesce(strip_py(F.col("review_text")), F.lit("")).alias("review_text"),
        score.alias("review_score"),
        F.coalesce(votes, F.lit(0)).alias("review_votes"),
        F.when(score == 1, "positive").otherwise("negative").alias("sentiment"),
        reason.alias("reject_reason"),
    )


def seq_id(df: DataFrame, out_col: str = "event_id", start: int = 1) -> DataFrame:
    """Consecutive ids (``start``, ``start+1``, ...) in input order, for a file scan.

    Input order is by file path, then by block start in the file, then by row.
    Scan partitions can't stand for it: splits are packed by size. Two passes,
    no single-partition window over rows: (1) row counts per (file, block), one
    row per block of the input; (2) the sum of the counts of all blocks before,
    added to the row's place in its block. A block's rows are read by one task
    in file order, so both passes and any retry see the same places. Apply it
    directly on a scan, before any shuffle.
    """
    file, block, mid = "__file", "__block", "__mid"
    tagged = df.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.file_block_start").alias(block),
                       F.monotonically_increasing_id().alias(mid))
    # the first id of a block turns the ids of its rows into places
    blocks = tagged.groupBy(file, block).agg(F.count(F.lit(1)).alias("__n"), F.min(mid).alias("__first"))
    in_order = Window.orderBy(file, block).rowsBetween(Window.unboundedPreceding, 0)
    offsets = blocks.select(F.col(file).alias("__f"), F.col(block).alias("__b"), "__first",
                            (F.sum("__n").over(in_order) - F.col("__n")).alias("__off"))
    return (tagged.join(offsets, (F.col(file) == F.col("__f")) & (F.col(block) == F.col("__b")))
            .withColumn(out_col, F.col("__off") + F.col(mid) - F.col("__first") + F.lit(start))
            .drop(file, block, mid, "__f", "__b", "__first", "__off"))


def cap_rows(df: DataFrame, n: int, id_col: str = "event_id", start: int = 1) -> DataFrame:
    """The first ``n`` rows by sequence id (a pushdown-able filter, not ``limit``)."""
    return df.where(F.col(id_col) < F.lit(start + n))


# --------------------------------------------------------------------------- bronze

def bronze_project(records: DataFrame) -> DataFrame:
    """Stream record -> bronze row: key/value as strings, source metadata, ingest time."""
    return records.selectExpr(
        "CAST(key AS STRING) AS kafka_key",
        "CAST(value AS STRING) AS raw_json",
        "topic",
        "CAST(partition AS INT) AS partition",
        "CAST(offset AS BIGINT) AS offset",
        "timestamp AS kafka_timestamp",
    ).withColumn("ingest_time", F.current_timestamp())


def parse_json(bronze: DataFrame, json_col: str = "raw_json",
               keep: tuple[str, ...] = (), schema: T.StructType | None = None) -> DataFrame:
    """JSON value -> typed fields, flattened (default: the 9 event fields).

    PERMISSIVE: a malformed document or a field of the wrong type gives null
    fields and the raw text in ``_corrupt_record``; nothing raises.
    """
    s = _PARSE_SCHEMA if schema is None else T.StructType(
        schema.fields + [T.StructField(CORRUPT_COL, T.StringType())])
    parsed = F.from_json(F.col(json_col), s,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL})
    return bronze.select(*keep, parsed.alias("data")).select(*keep, "data.*")


def parse_event_time(df: DataFrame, src: str = "timestamp", out: str = "event_time") -> DataFrame:
    """ISO-8601 string -> timestamp; unparseable -> null (``try_to_timestamp``)."""
    return df.withColumn(out, F.try_to_timestamp(F.col(src)))


def normalise_text(df: DataFrame, cols: tuple[str, ...] = ("event_type", "sentiment")) -> DataFrame:
    """``trim(lower(x))`` on the given columns."""
    for c in cols:
        df = df.withColumn(c, F.trim(F.lower(F.col(c))))
    return df


def reject_reason(classes: list[str] = SENTIMENTS) -> Column:
    """First failed validity test, or null for a valid silver row."""
    return (F.when(F.col("event_id").isNull(), F.lit("missing_event_id"))
            .when(F.col("app_id").isNull(), F.lit("missing_app_id"))
            .when(F.col("app_name").isNull(), F.lit("missing_app_name"))
            .when(F.col("review_score").isNull(), F.lit("missing_review_score"))
            .when(F.col("sentiment").isNull() | ~F.col("sentiment").isin(*classes),
                  F.lit("invalid_sentiment")))


def tag_events(bronze: DataFrame) -> DataFrame:
    """parse_json -> parse_event_time -> normalise_text -> ``reject_reason`` column."""
    df = parse_json(bronze, keep=("raw_json",))
    df = normalise_text(parse_event_time(df))
    return df.withColumn("reject_reason", reject_reason())


def clean_events(tagged: DataFrame) -> DataFrame:
    """Valid silver rows (the reference's five predicates), silver columns only."""
    from reviewlake.schemas import SILVER_COLUMNS
    return tagged.where(F.col("reject_reason").isNull()).select(*SILVER_COLUMNS)


def reject_events(tagged: DataFrame) -> DataFrame:
    """Rows failing a predicate, with the raw JSON and the reason."""
    return tagged.where(F.col("reject_reason").isNotNull()).select(
        "raw_json", "event_id", "reject_reason", F.col(CORRUPT_COL).isNotNull().alias("malformed"))


def bronze_to_silver(bronze: DataFrame) -> DataFrame:
    """Bronze -> silver in one expression (parse, time, normalise, validate)."""
    return clean_events(tag_events(bronze))


def dedup_events(silver: DataFrame, key: str = "event_id",
                 order: tuple[str, ...] | None = None) -> DataFrame:
    """One row per key, earliest by ``order`` (then by the full row) wins; nulls come last.

    ``order`` defaults to the stream's topic, partition and offset where the
    rows have them (the earliest offset is the first delivery), else to the
    event time. ``min_by`` over a struct is a partial aggregate: duplicates collapse on the
    map side, so a key with millions of copies ships one row per map task.
    """
    stream = ("topic", "partition", "offset")
    if order is None:
        order = stream if set(stream) <= set(silver.columns) else ("event_time",)
    others = [c for c in silver.columns if c != key]
    ranked = [*order, *[c for c in others if c not in order]]
    order_key = F.struct(*[x for i, c in enumerate(ranked) for x in (
        F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}"))])
    best = F.min_by(F.struct(*[F.col(c) for c in others]), order_key)
    return silver.groupBy(key).agg(best.alias("__r")).select(key, "__r.*").select(*silver.columns)


# --------------------------------------------------------------------------- model side

def model_frame(df: DataFrame, text_col: str = "review_text", class_col: str = "sentiment",
                classes: list[str] = SENTIMENTS, keep: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """Text + label rows for training: non-null text, known class, ``label_text`` copy."""
    return (df.where(F.col(text_col).isNotNull() & F.col(class_col).isin(*classes))
            .select(*keep, text_col, class_col, F.col(class_col).alias("label_text")))


def class_filter(df: DataFrame, label: str, label_col: str = "label_text") -> DataFrame:
    """Rows of one class."""
    return df.where(F.col(label_col) == label)


def map_values(col: Column | str, mapping: dict, default: Column | str | None = None) -> Column:
    """Literal code -> display-name lookup; unmapped -> ``default`` (null if None).

    Pass ``default=col`` to keep unmapped values unchanged.
    """
    c = F.col(col) if isinstance(col, str) else col
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    looked = m[c]
    if default is None:
        return looked
    d = F.col(default) if isinstance(default, str) else default
    return F.coalesce(looked, d.cast("string"))


def abs_importance(df: DataFrame, col: str = "importance") -> DataFrame:
    """Adds ``abs_importance`` and ``direction`` (>= 0 positive, else negative)."""
    return (df.withColumn("abs_importance", F.abs(F.col(col)))
            .withColumn("direction", F.when(F.col(col) >= 0, "positive").otherwise("negative")))


def probability_columns(pred: DataFrame, prob_col: str = "probability",
                        as_float: bool = True) -> DataFrame:
    """Per-class probability columns from the probability vector or array (no Python UDF)."""
    from pyspark.ml.functions import vector_to_array
    arr = F.col(prob_col)
    if not isinstance(pred.schema[prob_col].dataType, T.ArrayType):
        arr = vector_to_array(arr)
    t = "float" if as_float else "double"
    return (pred.withColumn("probability_negative", arr[0].cast(t))
            .withColumn("probability_positive", arr[1].cast(t)))
