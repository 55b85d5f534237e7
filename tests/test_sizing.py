"""Shuffles of large inputs: what a task holds does not grow with the input, and rows are not shuffled more often than needed."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from skyledger.operators import sizing
from skyledger.plans import dashboards, vault
from skyledger.sources import fixture

from .conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def small_partitions(monkeypatch):
    monkeypatch.setattr(sizing, "PARTITION_BYTES", 1 << 12)


def test_partitions_follow_the_largest_input(spark, small_partitions):
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = sizing.shuffle_partitions(lines)
    assert n > least and n % least == 0
    assert sizing.shuffle_partitions(lines.join(spark.read.parquet(f"{SF_SMALL}/nation.parquet"), F.col("l_orderkey") == F.col("n_nationkey"))) == n
    assert sizing.shuffle_partitions(spark.range(10)) == least
    assert sizing.shuffle_partitions(spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "a int")) == least  # no size known


def test_legs_are_grouped_in_partitions_of_bounded_size(spark, small_partitions):
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    n = sizing.shuffle_partitions(lines)
    for legs in (fixture.ticket_flights_snapshot(lines, fixture.SNAPSHOT_OLD_FLAGS), fixture.ticket_flights(lines), fixture.boarding_passes(lines)):
        assert set(re.findall(r"Exchange hashpartitioning\(.*, (\d+)\), (\w+)", _plan(legs))) == {(str(n), "REPARTITION_BY_NUM")}


def _vault(spark):
    return vault.build_vault(fixture.airline_tables(spark, SF_SMALL), "2001-08-01 00:00:00")


def test_legs_lie_by_ticket_in_partitions_of_bounded_size(spark, small_partitions):
    t = fixture.airline_tables(spark, SF_SMALL)
    n = sizing.shuffle_partitions(t["ticket_flights"])
    assert n > int(spark.conf.get("spark.sql.shuffle.partitions"))
    v = vault.build_vault(t, "2001-08-01 00:00:00")
    for table in ("link_ticket_flight", "sat_ticket_flight_details"):
        assert re.findall(r"hashpartitioning\(ticket_no#\d+, (\d+)\), REPARTITION_BY_NUM", _plan(v[table])) == [str(n)]


def test_legs_keep_every_pass_and_legs_without_one(spark):
    t = {"ticket_flights": spark.createDataFrame([("t1", 1, 5), ("t1", 2, 6), ("t2", 1, 7), ("t3", None, 8), ("t9", 1, 9)], "ticket_no string, flight_id int, amount int"),
         "boarding_passes": spark.createDataFrame([("t1", 1, 1, "1A"), ("t1", 1, 2, "1B"), ("t2", 2, 3, "2A"), ("t3", None, 4, "3A")],
                                                  "ticket_no string, flight_id int, boarding_no int, seat_no string"),
         "tickets": spark.createDataFrame([("t1", "b1", "p1"), ("t2", "b1", "p2"), ("t3", "b2", "p1")], "ticket_no string, book_ref string, passenger_id string")}
    src = vault.sources(t)
    got = sorted((tuple(r) for r in src["ticket_legs"].select("ticket_no", "flight_id", "amount", "boarding_no", "seat_no", "book_ref", "passenger_id").collect()), key=str)
    assert got == sorted([("t1", 1, 5, 1, "1A", "b1", "p1"), ("t1", 1, 5, 2, "1B", "b1", "p1"), ("t1", 2, 6, None, None, "b1", "p1"),
                          ("t2", 1, 7, None, None, "b1", "p2"), ("t3", None, 8, None, None, "b2", "p1")], key=str)
    assert sorted((tuple(r) for r in src["ticket_leg_keys"].select("ticket_no", "flight_id").collect()), key=str) == sorted(
        [("t1", 1), ("t1", 2), ("t2", 1), ("t3", None)], key=str)


def test_passengers_are_grouped_where_they_lie(spark):
    v, as_of = _vault(spark), dt.date(2001, 8, 1)
    for df in (dashboards.passenger_metrics_30d(v, as_of), dashboards.passenger_groups_revenue(v, as_of, latest=True, revenue="ticket_amount"),
               dashboards.dashboard_kpis(v, as_of)):
        p = _plan(df)
        assert len(re.findall(r"hashpartitioning\(passenger_id", p)) <= 1  # the hub's keys are made distinct
        assert len(re.findall(r"hashpartitioning\(passenger_hub_id#\d+, \d+\), REPARTITION_BY_NUM", p)) == 1
