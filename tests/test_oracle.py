"""Every query with an SQL form equals its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from reviewlake import plans
from reviewlake.plans.round_cols import ROUND_COLS
from tools.plan_report import BOUNDED_WINDOWS, final_plan, summarise
from tests.util import duck, rows

ORACLE = plans.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    types = [f.dataType.simpleString() for f in df.schema.fields]
    assert not [t for t in types if t.split("<")[0] in ("array", "map", "struct", "vector")]
    doubles = [f.name for f in df.schema.fields if f.dataType.simpleString() in ("double", "float")]
    assert doubles == ROUND_COLS.get(name, []), "run tools/gen_round_cols.py"
    got = df.toPandas()
    # the plan that just ran: no row-at-a-time Python, and every window without a
    # partition key is one reviewed as running over a bounded frame
    shape = summarise(df._jdf.queryExecution().executedPlan().toString())
    assert shape["python"] == 0
    assert shape["unpartitioned_windows"] == 0 or name in BOUNDED_WINDOWS
    want = con.execute(ORACLE[name]).df()
    c1, r1 = rows(got)
    c2, r2 = rows(want)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(E.queries())


def test_plan_summary_sees_subqueries_and_single_partitions(spark):
    """Scalar subqueries hide behind a first "Final Plan"; one-task exchanges are capitalised."""
    from reviewlake.plans import QUERIES
    df = QUERIES["tfidf"](spark, SF_SMALL)
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    shape = summarise(qe.executedPlan().toString())
    assert shape["shuffles"] >= 3 and shape["single"] >= 1
    assert len([ln for ln in shape["scan_lines"] if "documents" in ln]) >= 2  # rows, and their count


def test_auc_has_no_range_exchange(spark):
    from reviewlake.plans import QUERIES
    df = QUERIES["auc"](spark, SF_SMALL)
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    assert summarise(qe.executedPlan().toString())["range"] == 0


def test_samples_read_texts_once_and_do_not_shuffle_them(spark):
    from reviewlake.operators import sampling as S
    from reviewlake.sources.tables import texts
    df = S.per_group_sample(texts(spark, SF_SMALL), 3, "app_id")
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    shape = summarise(qe.executedPlan().toString())
    assert len([ln for ln in shape["scan_lines"] if "text:string" in ln]) == 1
    assert not [ln for ln in final_plan(qe.executedPlan().toString()) if "Exchange hash" in ln and "review_text" in ln]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["app_id", "app_name", "review_count", "avg_review_votes"]
