"""Queries with SQL equal DuckDB's answer on whole tables."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.util import duck, rows

NAMES = [n for n in E.oracle_sql() if n.startswith("op")]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = duck(SF_SMALL).execute(E.oracle_sql()[name]).df()
    assert rows(got) == rows(want)


def test_every_operator_has_a_query():
    names = E.queries()
    assert [len([n for n in names if n.startswith(f"op{i}_")]) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names
