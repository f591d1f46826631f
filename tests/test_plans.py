"""Properties of physical plans that keep the queries fit for large tables."""

import re

import pytest

from settings import SF
from pricewatch.plans import queries as q


@pytest.fixture
def plan(spark, capsys):
    def text(query):
        query(spark, SF).explain("formatted")
        return capsys.readouterr().out

    return text


def test_scan_reads_two_columns_and_pushes_the_filter(plan):
    p = plan(q.volatility_cv)
    assert "ReadSchema: struct<event_type:string,value:double>" in p
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,0.0), LessThan(value,Infinity)]" in p
    assert len(re.findall(r"^\(\d+\) Exchange", p, re.M)) == 1
    assert "partial_var_pop" in p


@pytest.mark.parametrize("query", [q.volatility_cv, q.trend_periodic, q.price_alert, q.news_counts_by_daypart])
def test_aggregates_hash(plan, query):
    assert "SortAggregate" not in plan(query)


@pytest.mark.parametrize("query", [q.price_alert_scaled, q.alert_last3, q.rolling_avg])
def test_windows_read_pruned_parquet_slices(plan, query):
    p = plan(query)
    assert "ExistingRDD" not in p and p.count("slices-") >= 2
    assert all("props" not in schema for schema in re.findall(r"ReadSchema: (.*)", p))


def test_dedup_and_newest_reduce_before_the_shuffle(plan):
    for query, stages in ((q.dedup_composite, 1), (q.dedup_link, 1), (q.clean_news, 1), (q.live_latest_n, 2)):
        p = plan(query)
        assert len(re.findall(r"Arguments: .*row_number\(\), \d+, Partial", p)) == stages, query.__name__


def test_small_sides_are_broadcast_by_their_bytes(plan):
    p = plan(q.zscore_anomaly)
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
