"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from tests.oracle import compare, connect
from tidegauge.plans import event_oracles, events, series, series_oracles

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {**events.QUERIES, **series.QUERIES}
ORACLES = {**event_oracles.ORACLES, **series_oracles.ORACLES}


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, tables, name):
    result = entry_points.queries()[name](spark, SF_DIR)
    assert compare(result, tables, entry_points.oracle_sql()[name]) == []


def test_entry_runs(spark):
    assert entry_points.entry(spark).columns == [
        "window_start",
        "window_end",
        "value_sum",
        "value_count",
    ]


def test_other_session_zone_gives_the_same(spark, tables):
    abroad = spark.newSession()
    abroad.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    for name in ("tumbling_mean_1h", "metric_defs_multi", "time_texts", "envelope_roundtrip"):
        result = entry_points.queries()[name](abroad, SF_DIR)
        assert compare(result, tables, entry_points.oracle_sql()[name]) == [], name
    assert abroad.conf.get("spark.sql.session.timeZone") == "Asia/Kolkata"
