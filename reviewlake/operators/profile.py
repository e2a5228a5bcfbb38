"""Profiling aggregates over a silver-shaped frame (section 2.5 / 2.7).

Every function is ``DataFrame -> DataFrame`` and runs on the whole table:
grouped aggregates use Spark's partial/final hash aggregation (map-side
combine, so a hot key costs one row per map task, not one row per event),
top-k uses ``orderBy(...).limit(k)`` with a full tie-break so Catalyst plans a
bounded ``TakeOrderedAndProject``, and global scalars (min, max, totals) are
scalar subqueries rather than joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.functions.exprs import strip_py


LENGTH_COL = "review_text_length"


def _length(df: DataFrame, text_col: str) -> Column:
    """Text length: a precomputed ``review_text_length`` column if present."""
    return F.col(LENGTH_COL) if LENGTH_COL in df.columns else F.length(text_col)


def _stack(cols: list[tuple[str, Column]], name_col: str, value_col: str) -> list[Column]:
    """``stack`` expression turning one wide row into (name, value) rows."""
    args = ", ".join(f"'{n}', `{n}`" for n, _ in cols)
    return [F.expr(f"stack({len(cols)}, {args}) AS (`{name_col}`, `{value_col}`)")]


def basic_summary(df: DataFrame, app_col: str = "app_id", class_col: str = "sentiment",
                  approx: bool = False) -> DataFrame:
    """(metric, value): total rows, distinct apps, distinct sentiments; one pass.

    ``approx=True`` swaps the exact distinct counts (an Expand + two-phase
    distinct aggregation) for HyperLogLog++ sketches.
    """
    distinct = F.approx_count_distinct if approx else F.countDistinct
    wide = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        distinct(app_col).cast("bigint").alias("unique_apps"),
        distinct(class_col).cast("bigint").alias("unique_sentiments"),
    )
    names = [("total_rows", None), ("unique_apps", None), ("unique_sentiments", None)]
    return wide.select(*_stack(names, "metric", "value"))


def missing_values(df: DataFrame) -> DataFrame:
    """One row, one bigint per column: its null count (single pass)."""
    return df.select([F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns])


def missing_report(df: DataFrame) -> DataFrame:
    """(column, null_count, blank_count) for every column, single pass.

    ``blank_count`` counts strings that are empty after stripping all
    whitespace (Python ``str.strip()`` rules); a producer
    that turns missing text into ``""`` shows up here, not in the null count.
    """
    exprs = []
    for f in df.schema.fields:
        c = F.col(f.name)
        exprs.append(F.count(F.when(c.isNull(), 1)).alias(f"{f.name}__n"))
        if f.dataType.simpleString() == "string":
            exprs.append(F.count(F.when(strip_py(c) == "", 1)).alias(f"{f.name}__b"))
        else:
            exprs.append(F.lit(0).cast("bigint").alias(f"{f.name}__b"))
    wide = df.agg(*exprs)
    args = ", ".join(f"'{f.name}', `{f.name}__n`, `{f.name}__b`" for f in df.schema.fields)
    return wide.select(F.expr(
        f"stack({len(df.columns)}, {args}) AS (`column`, `null_count`, `blank_count`)"))


def sentiment_distribution(df: DataFrame, class_col: str = "sentiment") -> DataFrame:
    """(sentiment, count), most frequent first, ties by name."""
    return (df.groupBy(class_col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(class_col)))


def sentiment_share(df: DataFrame, class_col: str = "sentiment") -> DataFrame:
    """(sentiment, count, percent) where percent is of all rows.

    The total is a window over the *aggregated* rows (one per class), so the
    single-partition window sees only class-count rows.
    """
    counts = df.groupBy(class_col).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return (counts.withColumn("percent", F.col("count") * 100.0 / total)
            .orderBy(F.desc("count"), F.asc(class_col)))


def score_distribution(df: DataFrame, score_col: str = "review_score") -> DataFrame:
    """(review_score, count) ascending by score."""
    return (df.groupBy(score_col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.asc_nulls_first(score_col)))


def app_stats(df: DataFrame, keys: tuple[str, ...] = ("app_id", "app_name"),
              votes_col: str = "review_votes") -> DataFrame:
    """(app_id, app_name, review_count, avg_review_votes) for every app."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("review_count"),
        F.avg(votes_col).alias("avg_review_votes"),
    )


def top_apps(df: DataFrame, n: int = 20, keys: tuple[str, ...] = ("app_id", "app_name"),
             votes_col: str = "review_votes") -> DataFrame:
    """Top ``n`` apps by review count; ties broken by the app key."""
    return (app_stats(df, keys, votes_col)
            .orderBy(F.desc("review_count"), *[F.asc(k) for k in keys])
            .limit(n))


def top_apps_by_votes(df: DataFrame, n: int = 5, candidates: int | None = None,
                      min_reviews: int = 1) -> DataFrame:
    """Top ``n`` apps by mean votes.

    All apps having at least ``min_reviews`` reviews are ranked;
    ``candidates=20`` reproduces the dashboard (the pick is made among the 20
    most-reviewed apps).
    """
    pool = top_apps(df, candidates) if candidates else (
        app_stats(df).where(F.col("review_count") >= min_reviews))
    return (pool.withColumn("avg_review_votes", F.round("avg_review_votes", 3))
            .orderBy(F.desc("avg_review_votes"), F.desc("review_count"), F.asc("app_id"))
            .limit(n))


def hourly_trend(df: DataFrame, ts_col: str = "event_time") -> DataFrame:
    """(hour, count) per UTC hour of the event time, ascending."""
    return (df.groupBy(F.date_trunc("hour", F.col(ts_col)).alias("hour"))
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy("hour"))


def text_length(df: DataFrame, text_col: str = "review_text",
                out_col: str = "review_text_length") -> DataFrame:
    """Adds the character (code point) length of the text; null stays null."""
    return df.withColumn(out_col, _length(df, text_col))


def text_length_summary(df: DataFrame, class_col: str = "sentiment",
                        text_col: str = "review_text") -> DataFrame:
    """(sentiment, review_count, avg_review_text_length)."""
    return (df.groupBy(class_col).agg(
        F.count(F.lit(1)).alias("review_count"),
        F.avg(_length(df, text_col)).alias("avg_review_text_length"))
        .orderBy(class_col))


def length_gap(df: DataFrame, class_col: str = "sentiment",
               text_col: str = "review_text") -> DataFrame:
    """One row: mean length of negative and positive texts and their difference."""
    ln = _length(df, text_col)
    neg = F.avg(F.when(F.col(class_col) == "negative", ln))
    pos = F.avg(F.when(F.col(class_col) == "positive", ln))
    return df.agg(neg.alias("negative_avg_length"), pos.alias("positive_avg_length"),
                  (neg - pos).alias("length_gap"))


def exact_percentiles(df: DataFrame, value: Column, probs: tuple[float, ...],
                      group: tuple[str, ...] = (), prefix: str = "p") -> DataFrame:
    """Exact percentiles with linear interpolation (pandas / ``percentile`` rule).

    Built from a (group, value) -> count histogram, which is a distributed
    partial/final aggregation, then a running count per group over the
    *distinct* values. Spark's ``percentile`` instead merges every map task's
    value map inside one task per group, a hot spot when one group holds most
    rows. Output columns: ``{prefix}0, {prefix}1, ...`` in ``probs`` order.
    """
    g = list(group)
    h = (df.where(value.isNotNull()).groupBy(*g, value.alias("__v"))
         .agg(F.count(F.lit(1)).alias("__c")))
    run = Window.partitionBy(*g).orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    h = (h.withColumn("__cum", F.sum("__c").over(run))
         .withColumn("__n", F.sum("__c").over(Window.partitionBy(*g))))
    aggs = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("__n") - 1)
        lo, hi = F.floor(pos), F.ceil(pos)
        v_lo = F.min(F.when(F.col("__cum") > lo, F.col("__v"))).cast("double")
        v_hi = F.min(F.when(F.col("__cum") > hi, F.col("__v"))).cast("double")
        frac = F.max(pos - lo)
        aggs.append((v_lo + (v_hi - v_lo) * frac).alias(f"{prefix}{i}"))
    return h.groupBy(*g).agg(*aggs)


def length_counts(df: DataFrame, class_col: str = "sentiment", text_col: str = "review_text") -> DataFrame:
    """(class, length, n): the mergeable histogram that length reports come from.

    One partial/final aggregation; its rows are bounded by the classes and the
    longest text, not by the data. Null texts have a null length. Histograms of
    parts of a table add up to the table's (``merge_length_counts``).
    """
    return df.groupBy(class_col, _length(df, text_col).alias("length")).agg(F.count(F.lit(1)).alias("n"))


def merge_length_counts(counts: DataFrame, class_col: str = "sentiment") -> DataFrame:
    """(class, length, n) of all parts stacked in ``counts``."""
    return counts.groupBy(class_col, "length").agg(F.sum("n").alias("n"))


def _percentile(p: float, value: str, cum: str, total: str) -> Column:
    """Linear interpolation between the two values around place p * (total - 1)."""
    pos = F.lit(float(p)) * (F.col(total) - 1)
    at = lambda place: F.min(F.when(F.col(cum) > place, F.col(value))).cast("double")
    return at(F.floor(pos)) + (at(F.ceil(pos)) - at(F.floor(pos))) * F.max(pos - F.floor(pos))


def length_stats_of(counts: DataFrame, class_col: str = "sentiment") -> DataFrame:
    """Per class: n, mean, sample deviation, median and P75 from (class, length, n).

    One shuffle by class of the distinct lengths; windows give the running
    count, the total and the mean, one aggregate the rest. A class of null
    texts only has n = 0 and nulls.
    """
    whole = Window.partitionBy(class_col)
    run = whole.orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    n = F.when(F.col("length").isNotNull(), F.col("n")).otherwise(0)
    h = counts.withColumn("__k", n)
    h = h.withColumns({"__cum": F.sum("__k").over(run), "__n": F.sum("__k").over(whole),
                       "__mean": F.try_divide(F.sum(F.col("length").cast("double") * F.col("__k")).over(whole),
                                              F.sum("__k").over(whole).cast("double"))})
    off = F.col("length") - F.col("__mean")
    squares = F.sum(F.col("__k") * off * off)
    return (h.groupBy(class_col)
            .agg(F.max("__n").alias("n"), F.max("__mean").alias("mean_length"),
                 F.sqrt(F.try_divide(squares, F.max("__n") - 1)).alias("std_length"),
                 _percentile(0.5, "length", "__cum", "__n").alias("median_length"),
                 _percentile(0.75, "length", "__cum", "__n").alias("p75_length"))
            .orderBy(class_col))


def length_quantiles_of(counts: DataFrame, probs: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row of length quantiles over all classes from (class, length, n)."""
    per_length = counts.where(F.col("length").isNotNull()).groupBy("length").agg(F.sum("n").alias("n"))
    run = Window.orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    h = per_length.withColumns({"__cum": F.sum("n").over(run), "__n": F.sum("n").over(Window.partitionBy())})
    return h.agg(*[_percentile(p, "length", "__cum", "__n").alias(f"p{round(p * 100)}") for p in probs])


def length_summary_of(counts: DataFrame, class_col: str = "sentiment") -> DataFrame:
    """(class, review_count, avg_review_text_length) from (class, length, n)."""
    known = F.when(F.col("length").isNotNull(), F.col("n"))
    return (counts.groupBy(class_col)
            .agg(F.sum("n").alias("review_count"),
                 F.try_divide(F.sum(F.col("length") * F.col("n")).cast("double"), F.sum(known).cast("double"))
                 .alias("avg_review_text_length")).orderBy(class_col))


def length_stats(df: DataFrame, class_col: str = "sentiment", text_col: str = "review_text",
                 exact: bool = True, accuracy: int = 100000) -> DataFrame:
    """Per class: n, mean, sample std, median and P75 of text length, from one scan.

    Exact percentiles interpolate linearly (as pandas does) and come, like the
    moments, from the distributed length histogram; ``exact=False`` uses the
    mergeable ``percentile_approx`` sketch instead.
    """
    if exact:
        return length_stats_of(length_counts(df, class_col, text_col), class_col)
    ln = _length(df, text_col)
    return (df.groupBy(class_col)
            .agg(F.count(ln).alias("n"), F.avg(ln).alias("mean_length"), F.stddev_samp(ln).alias("std_length"),
                 F.percentile_approx(ln, [0.5, 0.75], accuracy).cast("array<double>").alias("_q"))
            .select(class_col, "n", "mean_length", "std_length",
                    F.col("_q")[0].alias("median_length"), F.col("_q")[1].alias("p75_length"))
            .orderBy(class_col))


def length_quantiles(df: DataFrame, text_col: str = "review_text",
                     probs: tuple[float, ...] = (0.25, 0.5, 0.75), exact: bool = True,
                     accuracy: int = 100000) -> DataFrame:
    """One row of length quantiles over all rows (``p25``, ``p50``, ``p75``)."""
    ln = _length(df, text_col)
    if exact:
        return length_quantiles_of(df.groupBy(ln.alias("length")).agg(F.count(F.lit(1)).alias("n")), probs)
    row = df.agg(F.percentile_approx(ln, list(probs), accuracy).cast("array<double>").alias("_q"))
    return row.select([F.col("_q")[i].alias(f"p{round(p * 100)}") for i, p in enumerate(probs)])


def length_histogram(df: DataFrame, bins: int = 60, class_col: str = "sentiment",
                     text_col: str = "review_text") -> DataFrame:
    """(sentiment, bin, bin_start, bin_end, count): equal-width bins of text length.

    Bin edges span [min, max] over all classes; the max falls in the last bin.
    min/max come from one scalar subquery (one small job), so the histogram
    itself is a single grouped aggregation with no join.
    """
    ln = _length(df, text_col)
    lengths = df.where(ln.isNotNull())
    bounds = lengths.select(F.struct(F.min(ln).cast("double").alias("lo"),
                                     F.max(ln).cast("double").alias("hi"))).scalar()
    lo, hi = bounds["lo"], bounds["hi"]
    width = F.greatest((hi - lo) / F.lit(float(bins)), F.lit(1e-12))
    b = F.least(F.floor((ln - lo) / width), F.lit(bins - 1)).cast("int")
    return (lengths.groupBy(class_col, b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("count"))
            .select(class_col, "bin",
                    (lo + F.col("bin") * width).alias("bin_start"),
                    (lo + (F.col("bin") + 1) * width).alias("bin_end"),
                    "count")
            .orderBy(class_col, "bin"))


def app_sentiment_share(df: DataFrame, n: int = 10, app_col: str = "app_name",
                        class_col: str = "sentiment") -> DataFrame:
    """Per app: positive/negative counts and percents; top ``n`` by total.

    A fixed-value pivot written as conditional counts (one aggregation, no
    distinct-values job, zero-filled by construction).
    """
    agg = df.groupBy(app_col).agg(
        F.count(F.when(F.col(class_col) == "positive", 1)).alias("positive"),
        F.count(F.when(F.col(class_col) == "negative", 1)).alias("negative"),
    ).withColumn("total", F.col("positive") + F.col("negative"))
    return (agg.where(F.col("total") > 0)
            .withColumn("positive_pct", F.col("positive") * 100.0 / F.col("total"))
            .withColumn("negative_pct", F.col("negative") * 100.0 / F.col("total"))
            .orderBy(F.desc("total"), F.asc(app_col))
            .limit(n))


def votes_filter(df: DataFrame, votes_col: str = "review_votes") -> DataFrame:
    """Rows with non-negative votes (null votes are dropped)."""
    return df.where(F.col(votes_col) >= 0)


def length_votes_trend(df: DataFrame, points: int = 100, text_col: str = "review_text",
                       votes_col: str = "review_votes") -> DataFrame:
    """Least-squares line of votes on text length, sampled at ``points`` x values.

    Slope/intercept come from the ``regr_*`` aggregates (one pass over all
    rows, no driver sample); the fitted points are generated from the one
    result row with ``sequence`` + ``explode``.
    """
    x = _length(df, text_col).cast("double")
    y = F.col(votes_col).cast("double")
    fit = (votes_filter(df, votes_col).where(x.isNotNull())
           .agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                F.min(x).alias("x_min"), F.max(x).alias("x_max"), F.count(F.lit(1)).alias("n")))
    step = F.when(F.lit(points) > 1,
                  (F.col("x_max") - F.col("x_min")) / F.lit(max(points - 1, 1))).otherwise(0.0)
    return (fit.where(F.col("n") > 0)
            .select("slope", "intercept", "x_min", step.alias("step"),
                    F.explode(F.sequence(F.lit(0).cast("long"), F.lit(points - 1).cast("long")))
                    .alias("i"))
            .select("i", "slope", "intercept",
                    (F.col("x_min") + F.col("i") * F.col("step")).alias("x"))
            .withColumn("y_fit", F.col("intercept") + F.col("slope") * F.col("x"))
            .orderBy("i"))


def class_distribution(df: DataFrame, label_col: str = "label_text") -> DataFrame:
    """(label_text, count) in label order."""
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("count")).orderBy(label_col)


def class_balance_comparison(real: DataFrame, balanced: DataFrame,
                             label_col: str = "label_text") -> DataFrame:
    """(source, label_text, count): class counts before and after balancing."""
    a = class_distribution(real, label_col).withColumn("source", F.lit("real"))
    b = class_distribution(balanced, label_col).withColumn("source", F.lit("balanced"))
    return a.unionByName(b).select("source", label_col, "count")


def profile(df: DataFrame, app_col: str = "app_id", class_col: str = "sentiment",
            text_col: str = "review_text", classes: tuple[str, ...] = ("negative", "positive")
            ) -> DataFrame:
    """(metric, value): the profiling job's scalar reports from ONE scan.

    Total rows, distinct apps and classes, null and blank counts of every
    column, rows and mean text length per class. Rows are first summed up by
    (app, class), partially in each task; only that small frame meets the two
    distinct counts, so no row is expanded for them. Instead of the text itself
    ``df`` may have ``review_text_length`` and ``review_text_blank``, computed
    where the text is stored (``sources.reviews(..., text="flags")``).
    """
    ln, flag = _length(df, text_col), f"{text_col}_blank"
    counts: dict[str, Column] = {}
    for f in df.schema.fields:
        if f.name == flag:
            counts[f"blank_{text_col}"] = F.col(flag)
        elif f.name == LENGTH_COL:
            counts[f"null_{text_col}"] = F.col(f.name).isNull()
        else:
            counts[f"null_{f.name}"] = F.col(f.name).isNull()
            if f.dataType.simpleString() == "string":
                counts[f"blank_{f.name}"] = strip_py(F.col(f.name)) == ""
    names = list(counts)
    part = df.groupBy(F.col(app_col).alias("__app"), F.col(class_col).alias("__class")).agg(
        F.count(F.lit(1)).alias("__n"), F.count(ln).alias("__texts"), F.sum(ln).alias("__chars"),
        *[F.count(F.when(counts[c], 1)).alias(c) for c in names])
    aggs = [F.coalesce(F.sum("__n"), F.lit(0)).cast("double").alias("total_rows"),
            F.countDistinct("__app").cast("double").alias("unique_apps"),
            F.countDistinct("__class").cast("double").alias("unique_sentiments"),
            *[F.coalesce(F.sum(c), F.lit(0)).cast("double").alias(c) for c in names]]
    for c in classes:
        mine = lambda x, c=c: F.sum(F.when(F.col("__class") == c, F.col(x)))
        aggs.append(F.coalesce(mine("__n"), F.lit(0)).cast("double").alias(f"rows_{c}"))
        aggs.append(F.try_divide(mine("__chars").cast("double"), mine("__texts").cast("double")).alias(f"avg_length_{c}"))
    wide = part.agg(*aggs)
    args = ", ".join(f"'{n}', `{n}`" for n in wide.columns)
    return wide.select(F.expr(f"stack({len(wide.columns)}, {args}) AS (`metric`, `value`)"))
