"""Dashboards kept day by day: partials of each flight day, combined over the window.

`refresh_days` computes the days it is given from the history layer (only the links of
their flights are read) and replaces them; a daily run adds one day, and the window of the
queries leaves the 31st out by partition pruning. Partials that combine exactly:

  day_flights     (flight_date, flight): satellite versions, distinct passengers, spend per version
  day_passengers  (flight_date, chunk): bitmap of the day's passengers over dense numbers
  day_airports    (flight_date, airport_code)
  day_spend       (flight_date, passenger): distinct flights and spend

Distinct passengers of a window are the bits of the days' bitmaps or-ed together (4 KB a chunk
of 32,768 passengers). Passengers have dense numbers from a stored table; a refresh
numbers those it sees first. Distinct flights per passenger do not add up over days when a
flight has versions on several days; their sum over passengers does from day_flights, where
a flight's passengers count once per window. Only the groups by passenger (Q5) need each flight
to lie on one day, which is so with `latest=True`.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numeric import cents, round_half_up_ratio
from ..operators import commits, sinks
from ..operators.ranking import bucket_by_thresholds, share_of_total
from . import dashboards

NUMBER_KEYS = {"passenger_numbers": "passenger_hub_id"}
PARTIALS = ("day_flights", "day_passengers", "day_airports", "day_spend")


# --- dense numbers -------------------------------------------------------------------------
def number_rows(keys: DataFrame, key: str, first, out: str) -> DataFrame:
    """Distinct keys with consecutive numbers from `first` on, without one task for all.

    Keys are range-partitioned once (a checkpoint fixes the ranges), counted per range, and
    numbered inside their range behind the ranges before it (one row per shuffle partition,
    the proven bound of its broadcast).
    """
    ranges = sinks.materialise(keys.select(key).distinct().repartitionByRange(key).withColumn("_b", F.spark_partition_id()))
    sizes = ranges.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_b", (F.sum("_n").over(Window.orderBy("_b")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy(key))
    return (ranges.withColumn("_at", inside).join(F.broadcast(before), "_b")
            .select(key, (F.lit(first) + F.col("_before") + F.col("_at") - 1).cast("long").alias(out)))


def passenger_numbers(spark: SparkSession, root: str, passengers: DataFrame) -> DataFrame:
    """(passenger_hub_id, passenger_no) of these passengers; new ones are numbered and stored first."""
    path = f"{root.rstrip('/')}/numbers"
    m = commits.read_manifest(spark, path)
    batch = commits.Batch(spark, path, "daily", max((r.batch_id for r in m.runs), default=-1) + 1, NUMBER_KEYS)
    known = batch.near("passenger_numbers", passengers)
    fresh = passengers if known is None else passengers.join(known.select("passenger_hub_id"), "passenger_hub_id", "left_anti")
    every = batch.read("passenger_numbers")
    first = 0 if every is None else (every.agg(F.max("passenger_no")).first()[0] or 0) + 1
    batch.write("passenger_numbers", number_rows(fresh, "passenger_hub_id", first, "passenger_no"))
    batch.commit()
    stored = commits.Batch(spark, path, "daily", batch.batch_id + 1, NUMBER_KEYS).near("passenger_numbers", passengers)
    return stored.select("passenger_hub_id", "passenger_no")


# --- partials of some days --------------------------------------------------------------------
def refresh_days(v, root: str, since: dt.date, until: dt.date | None, latest: bool = False) -> None:
    """Compute and replace the partials of the flight days since <= day < until (None: no end).

    Of the history only the window's flights and their links and versions are joined. The
    detail rows of the days are computed once into the shared checkpoint folder, grouped to
    (day, flight, passenger); the partials are aggregates of that.
    """
    as_of = since + dt.timedelta(days=dashboards.WINDOW_DAYS)  # the window filter begins WINDOW_DAYS before
    flights = dashboards.flight_versions(v, as_of, until, latest, by_date=True)
    rows = dashboards.ticket_rows(v, flights, latest)
    rows = (rows.join(v["hub_passengers"].select("passenger_hub_id"), "passenger_hub_id", "left_semi")
            .groupBy("flight_date", "flight_hub_id", "fv", "passenger_hub_id").agg(F.sum("money").alias("money")))
    rows = sinks.materialise(rows)
    spark = rows.sparkSession
    spent = F.col("money") * F.col("fv")
    numbers = passenger_numbers(spark, root, rows.select("passenger_hub_id").distinct())
    by_day = rows.select("flight_date", "passenger_hub_id").distinct().join(numbers, "passenger_hub_id")
    tables = {
        "day_flights": rows.groupBy("flight_date", "flight_hub_id").agg(
            F.count(F.lit(1)).alias("passengers"), F.sum(spent).alias("spent"), F.count(spent).alias("payers")),
        "day_passengers": by_day.groupBy("flight_date", F.bitmap_bucket_number("passenger_no").alias("chunk")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("passenger_no")).alias("bits")),
        "day_airports": dashboards.active_airport_days(v, as_of, until, latest),
        "day_spend": rows.groupBy("flight_date", "passenger_hub_id").agg(F.count(F.lit(1)).alias("flights"), F.sum(spent).alias("spent")),
    }
    for name in PARTIALS:
        sinks.replace_partitions(tables[name], f"{root.rstrip('/')}/{name}", ["flight_date"])


def read_days(spark: SparkSession, root: str, as_of: dt.date, until: dt.date | None = None) -> dict[str, DataFrame]:
    """The stored partials of the window's days (other days are not listed in the scan: partition pruning)."""
    out = {}
    for name in PARTIALS:
        df = spark.read.parquet(f"{root.rstrip('/')}/{name}").where(F.col("flight_date") >= F.lit(as_of - dt.timedelta(days=dashboards.WINDOW_DAYS)))
        out[name] = df if until is None else df.where(F.col("flight_date") < F.lit(until))
    return out


# --- dashboards from the partials ------------------------------------------------------------
def _passengers(days: DataFrame, *by: str) -> DataFrame:
    """Distinct passengers of all days (or per `by`), from the union of their bitmaps."""
    chunks = days.groupBy(*by, "chunk").agg(F.bitmap_or_agg("bits").alias("bits"))
    return chunks.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("long").alias("unique_passengers"))


def active_airports(d: dict[str, DataFrame]) -> DataFrame:
    """Q2 from days."""
    return (d["day_airports"].groupBy("flight_date").agg(F.count_distinct("airport_code").alias("active_airports"))
            .orderBy(F.asc_nulls_last("flight_date")))


def passenger_metrics(d: dict[str, DataFrame]) -> DataFrame:
    """Q4 from days."""
    spend = d["day_spend"].groupBy("flight_date").agg(F.sum(cents(F.col("spent"))).alias("_cents"), F.count("spent").alias("_n"),
                                                      F.sum("spent").alias("total_revenue"))
    flights = d["day_flights"].groupBy("flight_date").agg(F.sum("passengers").alias("_flights"))
    day = _passengers(d["day_passengers"], "flight_date").join(spend, "flight_date").join(flights, "flight_date")
    return (day.select("flight_date", "unique_passengers", round_half_up_ratio(F.col("_cents"), F.col("_n") * 100).alias("avg_check"),
                       round_half_up_ratio(F.col("_flights"), F.col("unique_passengers")).alias("avg_flights_per_passenger"), "total_revenue")
            .orderBy(F.asc_nulls_last("flight_date")))


def passenger_groups(d: dict[str, DataFrame]) -> DataFrame:
    """Q5 from days (of partials with each flight on one day)."""
    per = d["day_spend"].groupBy("passenger_hub_id").agg(F.sum("flights").alias("flights"), F.sum("spent").alias("spent"))
    group = bucket_by_thresholds(F.col("flights"), dashboards.GROUP_THRESHOLDS, dashboards.GROUP_LABELS)
    g = per.groupBy(group.alias("passenger_group")).agg(F.count(F.lit(1)).alias("passenger_count"), F.sum("spent").alias("group_revenue"))
    g = g.withColumn("_cents", cents(F.col("group_revenue")))
    return share_of_total(g, "_cents", "revenue_share_percent").drop("_cents").orderBy(F.desc_nulls_first("group_revenue"))


def kpis(d: dict[str, DataFrame]) -> DataFrame:
    """K1-K4 from days."""
    k1 = d["day_airports"].agg(F.count_distinct("airport_code").alias("active_airports_30d"))
    k2 = _passengers(d["day_passengers"])
    per_flight = d["day_flights"].groupBy("flight_hub_id").agg(F.max("passengers").alias("_p"), F.sum("spent").alias("_s"))
    totals = per_flight.agg(F.sum("_p").alias("_flights"), F.sum(cents(F.col("_s"))).alias("_cents"))
    one = k1.crossJoin(k2).crossJoin(totals)  # one row each
    n = F.col("unique_passengers")
    return one.select("active_airports_30d", n.alias("unique_passengers_30d"), round_half_up_ratio(F.col("_cents"), n * 100).alias("avg_check_30d"),
                      round_half_up_ratio(F.col("_flights"), n).alias("avg_flights_per_passenger_30d"))


def series(d: dict[str, DataFrame]) -> DataFrame:
    """K5 from days."""
    p = passenger_metrics(d).select("flight_date", "unique_passengers", "total_revenue")
    return (active_airports(d).join(p, "flight_date", "full")
            .select("flight_date", F.coalesce("active_airports", F.lit(0)).alias("active_airports"),
                    F.coalesce("unique_passengers", F.lit(0)).alias("unique_passengers"), "total_revenue")
            .orderBy(F.asc_nulls_last("flight_date")))
