"""Sampling, splitting, set-operation and id queries."""

from __future__ import annotations

from reviewlake.operators import clean as C
from reviewlake.operators import profile as P
from reviewlake.operators import sampling as S
from reviewlake.operators.reports import union_classes
from reviewlake.plans.registry import register, with_views
from reviewlake.sources.tables import reviews, table, texts

_MODEL_FRAME = ("SELECT event_id, review_text, sentiment, sentiment AS label_text FROM reviews "
                "WHERE review_text IS NOT NULL AND sentiment IN ('negative', 'positive')")
_TRAIN = "md5(CAST(event_id AS VARCHAR)) < 'cccccccc'"


def _hash_rank(partition: str | None, key: str = "event_id") -> str:
    part = f"PARTITION BY {partition} " if partition else ""
    return f"row_number() OVER ({part}ORDER BY md5(CAST({key} AS VARCHAR)), {key})"


# The reference's sample sizes, and small ones that cut every group of the test tables.
SIZES = {"": {"balanced": 25000, "union": 100000, "balance": 25000, "group": 75000, "n": 3000},
         "_small": {"balanced": 50, "union": 40, "balance": 50, "group": 5, "n": 100}}


def _register_samples(suffix: str, size: dict[str, int]) -> None:
    """The sampling queries at one set of sizes."""
    @register(f"balanced_sample{suffix}", with_views(f"""
SELECT event_id, label_text FROM (
  SELECT *, {_hash_rank('label_text')} AS rn FROM ({_MODEL_FRAME}) m) t
WHERE rn <= {size['balanced']}""", "reviews"))
    def q_balanced_sample(spark, sf):
        mf = C.model_frame(reviews(spark, sf))
        return S.balanced_sample(mf, size["balanced"]).select("event_id", "label_text")

    @register(f"union_classes{suffix}", with_views(f"""
SELECT event_id, label_text FROM (
  SELECT *, {_hash_rank('label_text')} AS rn FROM ({_MODEL_FRAME}) m) t
WHERE rn <= {size['union']}""", "reviews"))
    def q_union_classes(spark, sf):
        mf = C.model_frame(reviews(spark, sf)).select("event_id", "label_text")
        return union_classes(*[S.sample_n(C.class_filter(mf, c), size["union"]) for c in ("negative", "positive")])

    @register(f"class_balance_comparison{suffix}", with_views(f"""
SELECT 'real' AS source, label_text, count(*) AS count FROM ({_MODEL_FRAME}) m GROUP BY label_text
UNION ALL
SELECT 'balanced', label_text, count(*) FROM (
  SELECT *, {_hash_rank('label_text')} AS rn FROM ({_MODEL_FRAME}) m) t
WHERE rn <= {size['balance']} GROUP BY label_text""", "reviews"))
    def q_class_balance_comparison(spark, sf):
        mf = C.model_frame(reviews(spark, sf))
        return P.class_balance_comparison(mf, S.balanced_sample(mf, size["balance"]))

    @register(f"per_group_sample{suffix}", with_views(f"""
SELECT event_id, app_id FROM (SELECT *, {_hash_rank('app_id')} AS rn FROM texts) t
WHERE rn <= {size['group']}""", "texts"))
    def q_per_group_sample(spark, sf):
        return S.per_group_sample(texts(spark, sf), size["group"], "app_id").select("event_id", "app_id")

    @register(f"sample_n{suffix}", with_views(f"""
SELECT event_id FROM (SELECT *, {_hash_rank(None)} AS rn FROM texts) t
WHERE rn <= {size['n']}""", "texts"))
    def q_sample_n(spark, sf):
        return S.sample_n(texts(spark, sf), size["n"]).select("event_id")


for _suffix, _size in SIZES.items():
    _register_samples(_suffix, _size)


@register("class_filter", with_views(
    f"SELECT event_id, label_text FROM ({_MODEL_FRAME}) m WHERE label_text = 'negative'",
    "reviews"))
def q_class_filter(spark, sf):
    return C.class_filter(C.model_frame(reviews(spark, sf)), "negative").select(
        "event_id", "label_text")


@register("hash_split", with_views(f"""
SELECT event_id, CASE WHEN {_TRAIN} THEN 'train' ELSE 'test' END AS split
FROM texts""", "texts"))
def q_hash_split(spark, sf):
    return S.hash_split(texts(spark, sf), "event_id", 0.8).select("event_id", "split")


@register("leakage_check", with_views(f"""
SELECT event_id FROM texts te
WHERE NOT ({_TRAIN})
  AND review_text IN (SELECT review_text FROM texts WHERE {_TRAIN})""", "texts"))
def q_leakage_check(spark, sf):
    """Test rows (split by id) whose exact text is also in train: copies leak."""
    split = S.hash_split(texts(spark, sf).select("event_id", "review_text"))
    return S.leakage_check(S.train_part(split), S.test_part(split), "review_text").select(
        "event_id")


@register("exclude_training", with_views(f"""
SELECT event_id FROM texts
WHERE review_text NOT IN (SELECT review_text FROM texts WHERE {_TRAIN})""", "texts"))
def q_exclude_training(spark, sf):
    """Rows whose text never occurs in the training split (left anti join)."""
    r = texts(spark, sf).select("event_id", "review_text")
    train = S.train_part(S.hash_split(r))
    return S.exclude_training(r, train, "review_text").select("event_id")


@register("partition_by_key", with_views(
    "SELECT event_id, app_id FROM texts", "texts"))
def q_partition_by_key(spark, sf):
    return S.partition_by_key(texts(spark, sf).select("event_id", "app_id"), None, "app_id")


@register("seq_id", """
SELECT event_id, row_number() OVER (ORDER BY event_id) AS seq FROM events""")
def q_seq_id(spark, sf):
    """Sequence ids in file order (the events file is stored by event_id)."""
    return C.seq_id(table(spark, sf, "events").select("event_id"), "seq")


@register("cap_rows", """
SELECT event_id, seq FROM (
  SELECT event_id, row_number() OVER (ORDER BY event_id) AS seq FROM events) t
WHERE seq <= 1000""")
def q_cap_rows(spark, sf):
    ids = C.seq_id(table(spark, sf, "events").select("event_id"), "seq")
    return C.cap_rows(ids, 1000, "seq")



@register("balanced_sample_approx", with_views(f"""
SELECT m.event_id, m.label_text FROM ({_MODEL_FRAME}) m
JOIN (SELECT label_text, count(*) AS cnt FROM ({_MODEL_FRAME}) x GROUP BY label_text) c
  ON m.label_text = c.label_text
WHERE 50.0 / c.cnt >= 1.0
   OR substr(md5(CAST(m.event_id AS VARCHAR)), 1, 8)
      < lower(lpad(hex(CAST(floor(least(1.0, 50.0 / c.cnt) * 4294967296.0) AS BIGINT)), 8, '0'))""",
    "reviews"))
def q_balanced_sample_approx(spark, sf):
    """One-pass form: each class keeps the rows whose hash falls below n / class size."""
    mf = C.model_frame(reviews(spark, sf))
    return S.balanced_sample(mf, 50, exact=False).select("event_id", "label_text")
