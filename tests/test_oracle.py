"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from settings import SF
from pricewatch.plans import oracle, queries
from tools.check import compare, connect

QUERIES, SQL = queries.QUERIES, oracle.SQL


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 5
    assert df.columns[0] == "commodity"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name, capsys):
    """Same rows as the SQL, and no plan with a cross join or a Python worker."""

    def run(session, sf_dir):
        df = QUERIES[name](session, sf_dir)
        df.explain()
        return df

    message, ok, _ = compare(spark, duck, name, run, SQL.get(name), SF)
    plan = capsys.readouterr().out
    assert ok, message
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert operator not in plan
