"""Mixing sources to target weights by Poisson replication, column functions only.

A source of n rows that is to have a share w of N drawn rows has the mean rate
w * N / n. Each document draws a uniform number from a hash of seed and id and
inverts the Poisson distribution of its source's rate: that many copies of it
are made, and all copies are shuffled globally by a hash. Rates over
``CHUNK`` are sums of equal Poisson draws, so that no exponential underflows.

Source counts combine map-side and the corpus isn't shuffled by source: its
rates are broadcast if there are at most ``MAX_BROADCAST`` sources (counted),
else joined with each source's rate dealt to ``SALT`` keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import fresh, shared_path, text_or_empty

CHUNK, MAX_BROADCAST, SALT, SEED = 500.0, 10_000, 32, 17


def uniform(seed: int, *parts: Column) -> Column:
    """In [0, 1): 52 bits of the md5 of seed and parts."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def poisson_cdf(rate: Column) -> Column:
    """P(X <= k) for k from 0 to where the rest is below any 52-bit uniform's distance to 1."""
    top = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    zero = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("cdf"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * rate / k
        return F.struct(p.alias("p"), F.array_append(acc["cdf"], F.element_at(acc["cdf"], -1) + p).alias("cdf"))
    return F.aggregate(F.sequence(F.lit(1), top), zero, step, lambda acc: acc["cdf"])


def rates(docs: DataFrame, source_col: str, weights: dict[str, float] | None, temperature: float,
          total: int | None) -> DataFrame:
    """(source, n, rate) of every source; the sums over sources are two numbers."""
    src = F.col(f"`{source_col}`").cast("string")
    counts = docs.groupBy(src.alias("source")).agg(F.count(F.lit(1)).alias("n"))
    path = shared_path(docs.sparkSession, "sources")
    counts.write.parquet(path)
    counts = docs.sparkSession.read.schema("source string, n long").parquet(path)
    if weights is None:
        weight = F.pow("n", F.lit(temperature))
    else:
        weight = F.lit(0.0)
        for name, w in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(weight)
    row = counts.agg(F.sum("n").alias("n"), F.sum(weight).alias("w")).first()
    drawn, all_w = float(total if total is not None else row["n"] or 0), float(row["w"] or 0)
    share = weight / F.lit(all_w) if all_w else F.lit(0.0)
    return counts.select("source", "n", (share * F.lit(drawn) / F.col("n")).alias("rate"))


def mix(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", *,
        weights: dict[str, float] | None = None, temperature: float = 0.5, total: int | None = None,
        seed: int = SEED) -> DataFrame:
    """Copies of ``docs``: all its columns plus copy (from 1) and n_copies, globally shuffled.

    ``weights`` gives shares by source (a source not listed gets none);
    without it a source's share is in proportion to its count to the power
    ``temperature``. ``total`` rows are expected, by default as many as there
    are. A null source is a source; a null id draws by its text; rows that
    repeat id and text draw alike. Columns that have a new name are replaced.
    """
    new = ["copy", "n_copies"]
    base = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in new])
    key, draw, cdf, chunks, salt = fresh(base, "source", "draw", "cdf", "chunks", "salt")
    by_source = rates(base, source_col, weights, temperature, total)
    m = F.greatest(F.ceil(F.col("rate") / CHUNK), F.lit(1)).cast("int")
    by_source = by_source.select(
        F.col("source").alias(key), m.alias(chunks), poisson_cdf(F.col("rate") / m).alias(cdf))

    who = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.md5(text_or_empty(text_col)))
    rows = base.withColumn(draw, who)
    same = F.col(f"`{source_col}`").cast("string").eqNullSafe(F.col(key))
    if by_source.count() <= MAX_BROADCAST:
        rows = rows.join(F.broadcast(by_source), same)
    else:
        by_source = by_source.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        rows = rows.join(by_source, same & (F.pmod(F.xxhash64(draw), F.lit(SALT)) == F.col(salt)))

    numbers = F.transform(F.sequence(F.lit(1), F.col(chunks)), lambda i: uniform(seed, F.col(draw), i.cast("string")))
    rows = rows.withColumn("n_copies", F.aggregate(
        numbers, F.lit(0), lambda acc, u: acc + F.size(F.filter(F.col(cdf), lambda c: c <= u))))
    rows = rows.where(F.col("n_copies") > 0).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
    order = F.xxhash64(F.lit(seed), F.col(draw), F.col("copy"))
    rows = rows.withColumn(key, order).repartition(key).sortWithinPartitions(key)
    return rows.select(*[F.col(f"`{c}`") for c in base.columns], *new)
