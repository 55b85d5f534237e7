"""Dashboards from day partials against the detail queries."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skyledger import registry
from skyledger.operators import commits
from skyledger.plans import daily, dashboards

from .conftest import SF_SMALL

AS_OF = registry.AS_OF


def rows_of(df):
    return sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


def files(spark, root, name):
    return {f.split("flight_date=")[1] for f in spark.read.parquet(f"{root}/{name}").inputFiles()}


def test_days_combine_to_the_window(spark, scratch):
    """Every flight has versions on two days here: distinct flights, airports and passengers still count once."""
    v = registry._two_load_vault(spark, SF_SMALL)
    first, split = AS_OF - dt.timedelta(days=dashboards.WINDOW_DAYS), AS_OF - dt.timedelta(days=9)
    daily.refresh_days(v, scratch, first, split)
    daily.refresh_days(v, scratch, split, None)
    d = daily.read_days(spark, scratch, AS_OF)
    assert rows_of(daily.kpis(d)) == rows_of(dashboards.dashboard_kpis(v, AS_OF))
    assert rows_of(daily.series(d)) == rows_of(dashboards.daily_series(v, AS_OF))
    assert rows_of(daily.passenger_metrics(d)) == rows_of(dashboards.passenger_metrics_30d(v, AS_OF))
    assert rows_of(daily.active_airports(d)) == rows_of(dashboards.active_airports_30d(v, AS_OF))
    before = {n: files(spark, scratch, n) for n in daily.PARTIALS}
    numbers = commits.read_table(spark, f"{scratch}/numbers", "passenger_numbers")
    assert [r.passenger_no for r in numbers.orderBy("passenger_no").collect()] == list(range(numbers.count()))
    # one day again: only its partition changes, no passenger gets a second number
    daily.refresh_days(v, scratch, split, split + dt.timedelta(days=1))
    for n in daily.PARTIALS:
        kept = {f for f in before[n] if not f.startswith(str(split))}
        assert kept == {f for f in files(spark, scratch, n) if not f.startswith(str(split))} and files(spark, scratch, n) != before[n]
    assert rows_of(daily.kpis(daily.read_days(spark, scratch, AS_OF))) == rows_of(dashboards.dashboard_kpis(v, AS_OF))
    assert commits.read_table(spark, f"{scratch}/numbers", "passenger_numbers").count() == numbers.count()
    # the next day's window leaves the oldest day out
    later = AS_OF + dt.timedelta(days=1)
    assert rows_of(daily.kpis(daily.read_days(spark, scratch, later))) == rows_of(dashboards.dashboard_kpis(v, later))
    scan = daily.read_days(spark, scratch, later)["day_flights"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(flight_date" in scan


def test_groups_from_days_of_latest_versions(spark, scratch):
    v = registry._two_load_vault(spark, SF_SMALL)
    daily.refresh_days(v, scratch, AS_OF - dt.timedelta(days=dashboards.WINDOW_DAYS), None, latest=True)
    d = daily.read_days(spark, scratch, AS_OF)
    assert rows_of(daily.passenger_groups(d)) == rows_of(dashboards.passenger_groups_revenue(v, AS_OF, latest=True))


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_numbers_are_dense(spark, n):
    keys = spark.range(n).select(F.md5(F.col("id").cast("string")).alias("k"))
    got = [r.no for r in daily.number_rows(keys.unionAll(keys), "k", 7, "no").collect()]
    assert sorted(got) == list(range(7, 7 + n))
