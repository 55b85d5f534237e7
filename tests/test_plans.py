"""Plan-shape checks: no nested-loop / Cartesian joins, no global sort for ranking,
filters pushed into the parquet scan."""

import datetime as dt
import re

import pytest

from skyledger.plans import dashboards, marts, vault
from skyledger.sources import fixture
from skyledger.sources.tables import read_tables, write_tables

from .conftest import SF_SMALL

AS_OF = dt.date(2001, 8, 1)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _vault(spark):
    return vault.build_vault(fixture.airline_tables(spark, SF_SMALL), "2001-08-01 00:00:00")


def test_dashboards_use_equi_joins_only(spark):
    v = _vault(spark)
    for df in (dashboards.active_airports_30d(v, AS_OF), dashboards.airport_traffic_share(v, AS_OF)):
        p = _plan(df)
        assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_frequent_flyer_ranking_has_no_global_sort_of_detail(spark):
    t = fixture.airline_tables(spark, SF_SMALL)
    p = _plan(marts.build_frequent_flyers(t, AS_OF))
    # the only un-partitioned window is the one over per-bucket totals
    assert "percent_rank" not in p.lower().replace("_percent_rank", "")
    single = [m.start() for m in re.finditer("SinglePartition", p)]
    assert len(single) <= 1
    assert "Window [" in p and "_b" in p


def test_filters_reach_parquet_scan(spark, scratch):
    t = fixture.airline_tables(spark, SF_SMALL)
    write_tables({n: t[n] for n in ("flights", "ticket_flights", "tickets")}, scratch)
    stored = read_tables(spark, scratch, names=("flights", "ticket_flights", "tickets"))
    p = _plan(marts.flight_stats(stored, AS_OF))
    assert re.search(r"PushedFilters: \[[^\]]*In\(status", p)
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(scheduled_dep", p)
    # only the used columns are read from flights
    scans = [m.group(0) for m in re.finditer(r"FileScan parquet \[[^\]]*\]", p) if "status" in m.group(0)]
    assert scans and all("flight_no" not in s and "aircraft_code" not in s for s in scans)


def test_no_broadcast_beyond_the_session_threshold(spark):
    t = fixture.airline_tables(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        v = _vault(spark)
        plans = [_plan(marts.build_airport_passenger_flow(t, AS_OF)), _plan(dashboards.airport_traffic_share(v, AS_OF)),
                 _plan(dashboards.active_airports_30d(v, AS_OF))]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert all("BroadcastHashJoin" not in p for p in plans)


def test_booking_codes_are_unique_beyond_ten_million(spark):
    keys = spark.range(14_999_000, 15_001_000).union(spark.range(149_000, 151_000)).union(spark.range(2_176_782_000, 2_176_782_336))
    orders = keys.selectExpr("id AS o_orderkey", "current_timestamp() AS o_orderdate", "1.0 AS o_totalprice")
    codes = fixture.bookings(orders).select("book_ref")
    assert codes.distinct().count() == keys.count()
    assert codes.selectExpr("min(length(book_ref))", "max(length(book_ref))").first()[:] == (6, 6)
    with pytest.raises(Exception, match="base-36"):
        fixture.bookings(spark.range(36 ** 6, 36 ** 6 + 1).selectExpr("id AS o_orderkey", "current_timestamp() AS o_orderdate", "1.0 AS o_totalprice")).collect()


def test_dashboard_rows_come_in_order(spark):
    v = _vault(spark)
    days = [r.flight_date for r in dashboards.active_airports_30d(v, AS_OF).collect()]
    assert days == sorted(days) and len(days) > 1
    assert [r.flight_date for r in dashboards.passenger_metrics_30d(v, AS_OF).collect()] == sorted(
        r.flight_date for r in dashboards.passenger_metrics_30d(v, AS_OF).collect())
    flights = [r.total_flights for r in dashboards.airport_traffic_share(v, AS_OF).collect()]
    assert flights == sorted(flights, reverse=True)
    money = [r.group_revenue for r in dashboards.passenger_groups_revenue(v, AS_OF).collect()]
    assert money == sorted(money, reverse=True)


def test_constraint_reports_read_each_table_once(spark, scratch):
    from skyledger.plans import checks
    stored = {n: df for n, df in _vault(spark).items()}
    write_tables(stored, scratch)
    tables = read_tables(spark, scratch, names=tuple(stored))
    assert _plan(checks.vault_report(tables)).count("FileScan parquet") == len(stored)


def test_dashboards_cut_links_before_satellite_amounts(spark, scratch):
    """No aggregate stands directly on a whole booking or ticket-flight satellite."""
    stored = {n: df for n, df in _vault(spark).items()}
    write_tables(stored, scratch)
    v = read_tables(spark, scratch, names=tuple(stored))
    for latest in (False, True):
        p = dashboards.passenger_metrics_30d(v, AS_OF, latest=latest, revenue="ticket_amount")._jdf.queryExecution().optimizedPlan().toString()
        lines = p.splitlines()
        for i, line in enumerate(lines):
            if "amount#" in line and "Relation [" in line:
                above = lines[max(0, i - 3):i]          # its projection and filter
                assert not any("Aggregate" in x for x in above)


def test_two_loads_compare_business_keys_and_not_digests(spark):
    from skyledger import registry
    from skyledger.plans import vault
    flights = "flight_id int, departure_airport string, arrival_airport string, aircraft_code string"
    a = {"flights": spark.createDataFrame([(1, "A", "B", "x"), (2, None, "B", "x"), (2, None, "B", "x"), (None, "A", None, None)], flights)}
    b = {"flights": spark.createDataFrame([(1, "A", "B", "x"), (2, None, "B", "x"), (2, "B", None, "x"), (3, "A", "B", "y"), (3, "A", "B", "y"), (None, "A", None, None)], flights)}
    both = registry._two_loads(a, "2024-01-01 00:00:00", b, "2024-01-02 00:00:00")
    for name, key, n in (("hub_flights", "flight_hash_key", 3), ("link_flight_leg", "flight_leg_hash_key", 5)):
        first, second = (vault.build_vault(t, ts)[name] for t, ts in ((a, "2024-01-01 00:00:00"), (b, "2024-01-02 00:00:00")))
        want = first.unionByName(second.join(first, key, "left_anti"))
        assert sorted(map(repr, both[name].collect())) == sorted(map(repr, want.collect())) and want.count() == n
        plan = both[name]._jdf.queryExecution().optimizedPlan().toString()
        assert not any("Join" in line and "hash_key" in line for line in plan.split("\n"))
