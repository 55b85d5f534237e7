"""Dashboard queries over the history layer (Q2-Q5) and the KPI tiles (K1-K5).

As written, the reference joins every satellite version, so each extra
version of a flight or booking multiplies COUNT(*) and SUM (T10), and the
booking total is summed once per ticket-flight (T11). Those numbers are
reproduced exactly without carrying the fan-out along: the rows of the window
are cut first, each satellite is reduced to *version weights* of those rows (how
many versions, and the sum of their amounts) in the stage that joins it, and the
weights are multiplied along the join chain.
`latest=True` reads only the current version of every satellite;
`revenue="ticket_amount"` sums the ticket-flight amounts instead of booking
totals (the corrected variants).

Hubs and links are key-unique by construction (insert-if-absent), so joins
that only pass a key through are semi-joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import cents, round_half_up_ratio
from ..operators.joins import either_endpoint_join
from ..operators.ranking import bucket_by_thresholds, newest_version, share_of_total
from ..operators.sizing import shuffle_partitions

WINDOW_DAYS = 30
# Passenger groups by distinct flights in the window.
GROUP_THRESHOLDS = (10, 5)
GROUP_LABELS = ("Frequent Flyer", "Regular Customer", "Occasional Traveler")


def _sat(v: dict[str, DataFrame], name: str, parent: str, latest: bool) -> DataFrame:
    s = v[name]
    return newest_version(s, parent) if latest else s


def _per_row(rows: DataFrame, sat: DataFrame, parent: str, value: str, latest: bool,
             how: str = "inner") -> DataFrame:
    """`rows` with `_versions` and `_value` of their parent: the number of satellite
    versions and the sum of `value` over them, or 1 and the value of the newest one.

    The window's rows meet the satellite first and are grouped by themselves
    afterwards. The groups lie inside the parent key the join is partitioned by, so
    this adds no shuffle, and versions outside the window are never aggregated.
    """
    versions = sat.select(parent, F.col(value).alias("_one"), F.col("load_date").alias("_at"),
                          F.lit(1).alias("_hit"))
    if latest:
        measures = [F.max("_hit").cast("long").alias("_versions"), F.max_by("_one", "_at").alias("_value")]
    else:
        measures = [F.count("_hit").alias("_versions"), F.sum("_one").alias("_value")]
    return rows.join(versions, parent, how).groupBy(*rows.columns).agg(*measures)


def _window_filter(ts: Column, as_of, until=None) -> Column:
    since = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(WINDOW_DAYS))
    cond = ts >= since
    if until is not None:
        cond = cond & (ts < F.lit(until).cast("timestamp"))
    return cond


def flight_versions(v, as_of, until=None, latest=False, by_date=False) -> DataFrame:
    """flight_hub_id [, flight_date] -> fv: satellite versions inside the window
    (restricted to flights present in hub_flights)."""
    fd = v["sat_flight_details"].select("flight_hub_id", "scheduled_departure", "load_date")
    inside = _window_filter(F.col("scheduled_departure"), as_of, until)
    if latest:
        # only a flight with some version inside the window can have its newest one there
        fd = fd.join(fd.where(inside).select("flight_hub_id").distinct(), "flight_hub_id", "left_semi")
        fd = fd.groupBy("flight_hub_id").agg(F.max_by("scheduled_departure", "load_date").alias("scheduled_departure"))
    keys = ["flight_hub_id"] + (["flight_date"] if by_date else [])
    fd = fd.where(inside).select("flight_hub_id", F.to_date("scheduled_departure").alias("flight_date"))
    w = fd.groupBy(*keys).agg(F.count(F.lit(1)).alias("fv"))
    return w.join(v["hub_flights"].select("flight_hub_id"), "flight_hub_id", "left_semi")


def ticket_rows(v, flights_w: DataFrame, latest=False, revenue="booking_total") -> DataFrame:
    """Ticket-flight links of the window's flights with their booking and weight.

    Columns: flight_hub_id, passenger_hub_id, [flight_date,] fv, bv, money
    where `money` is what one join row contributes to SUM(...) times its
    multiplicity from the booking side. The window's flights cut the links before
    any satellite is touched. A ticket's flight is one link: with both ids rows need no link id.
    """
    tf = v["link_ticket_flight"].select("ticket_flight_link_id", "ticket_booking_link_id", "flight_hub_id")
    tb = v["link_ticket_booking"].select("ticket_booking_link_id", "booking_hub_id", "passenger_hub_id")
    rows = tf.join(flights_w, "flight_hub_id")
    if revenue == "ticket_amount":
        rows = (_per_row(rows, v["sat_ticket_flight_details"], "ticket_flight_link_id", "amount", latest, "left")
                .withColumn("_amt", F.coalesce("_value", F.lit(0))).drop("_value", "_versions"))
    rows = rows.drop("ticket_flight_link_id").join(tb, "ticket_booking_link_id")
    # the hub meets the satellite, by whose key both lie: asked of the rows, Spark would ask it of all links first
    known = v["sat_booking_details"].join(v["hub_bookings"].select("booking_hub_id"), "booking_hub_id", "left_semi")
    rows = _per_row(rows, known, "booking_hub_id", "total_amount", latest)
    money = F.col("_value") if revenue == "booking_total" else F.col("_amt").cast("decimal(20,2)") * F.col("_versions")
    return rows.withColumns({"bv": F.col("_versions"), "money": money}).drop("_versions", "_value")


# --- Q2 active airports per day ----------------------------------------------------
def active_airport_days(v, as_of, until=None, latest=False) -> DataFrame:
    """Distinct (flight_date, airport_code) of flights touching the airport."""
    fw = flight_versions(v, as_of, until, latest, by_date=True)
    legs = v["link_flight_leg"].select("flight_hub_id", "departure_airport_hub_id", "arrival_airport_hub_id")
    legs = legs.join(fw.select("flight_hub_id", "flight_date"), "flight_hub_id")
    airports = (v["hub_airports"].select("airport_hub_id", "airport_code")
                .join(v["sat_airport_details"].select("airport_hub_id"), "airport_hub_id", "left_semi"))
    j = either_endpoint_join(airports, "airport_hub_id", legs, "departure_airport_hub_id", "arrival_airport_hub_id")
    return j.select("flight_date", "airport_code").distinct()


def active_airports_30d(v, as_of, until=None, latest=False) -> DataFrame:
    return (active_airport_days(v, as_of, until, latest).groupBy("flight_date")
            .agg(F.count_distinct("airport_code").alias("active_airports"))
            .orderBy(F.asc_nulls_last("flight_date")))


# --- Q3 airport traffic share ---------------------------------------------------------
def airport_traffic_share(v, as_of, until=None, latest=False) -> DataFrame:
    fw = flight_versions(v, as_of, until, latest)
    tk = ticket_rows(v, fw, latest)
    # per (flight, passenger): rows contributed = fv * bv, summed over tickets
    per_fp = (tk.groupBy("flight_hub_id", "passenger_hub_id")
              .agg(F.sum(F.col("fv") * F.col("bv")).alias("w")))
    legs = v["link_flight_leg"].select("flight_hub_id", "departure_airport_hub_id", "arrival_airport_hub_id")
    airports = v["hub_airports"].select("airport_hub_id", "airport_code")
    per_leg = either_endpoint_join(airports, "airport_hub_id", legs.join(per_fp, "flight_hub_id"),
                                   "departure_airport_hub_id", "arrival_airport_hub_id")
    per_airport = (per_leg.groupBy("airport_hub_id", "airport_code")
                   .agg(F.sum("w").alias("_rows"), F.count_distinct("passenger_hub_id").alias("total_passengers")))
    ad = _sat(v, "sat_airport_details", "airport_hub_id", latest)
    names = ad.groupBy("airport_hub_id", "airport_name").agg(F.count(F.lit(1)).alias("av"))
    stats = (per_airport.join(names, "airport_hub_id")
             .groupBy("airport_code", "airport_name")
             .agg(F.sum(F.col("_rows") * F.col("av")).alias("total_flights"),
                  F.max("total_passengers").alias("total_passengers")))
    out = share_of_total(stats, {"total_flights": "flight_share_percent",
                                 "total_passengers": "passenger_share_percent"})
    return (out.select("airport_code", "airport_name", "total_flights", "flight_share_percent",
                       "total_passengers", "passenger_share_percent")
            .orderBy(F.desc_nulls_first("total_flights")))


def _per_passenger(v, rows: DataFrame, *by: str, flights: str) -> DataFrame:
    """passenger_id [, by]: distinct flights and spend. Rows are shuffled once, by passenger: the distinct flights and
    the hub's key follow there. Passengers and flights have one hub id each, so their ids count and group as the keys do."""
    rows = rows.select("passenger_hub_id", *by, "flight_hub_id", (F.col("money") * F.col("fv")).alias("_spent"))
    st = (rows.repartition(shuffle_partitions(rows), "passenger_hub_id").groupBy("passenger_hub_id", *by)
          .agg(F.count_distinct("flight_hub_id").alias(flights), F.sum("_spent").alias("total_spent")))
    return (st.join(v["hub_passengers"].select("passenger_hub_id", "passenger_id"), "passenger_hub_id")
            .select("passenger_id", *by, flights, "total_spent"))


# --- Q4 passenger metrics per day ------------------------------------------------------
def passenger_day_stats(v, as_of, until=None, latest=False, revenue="booking_total") -> DataFrame:
    fw = flight_versions(v, as_of, until, latest, by_date=True)
    return _per_passenger(v, ticket_rows(v, fw, latest, revenue), "flight_date", flights="flights_count")


def passenger_metrics_30d(v, as_of, until=None, latest=False, revenue="booking_total") -> DataFrame:
    st = passenger_day_stats(v, as_of, until, latest, revenue)  # a passenger's day is one row
    day = (st.groupBy("flight_date")
           .agg(F.count("passenger_id").alias("unique_passengers"),
                F.sum(cents(F.col("total_spent"))).alias("_cents"), F.count("total_spent").alias("_n"),
                F.sum("flights_count").alias("_flights"), F.count("flights_count").alias("_nf"),
                F.sum("total_spent").alias("total_revenue")))
    return (day.select("flight_date", "unique_passengers",
                       round_half_up_ratio(F.col("_cents"), F.col("_n") * 100).alias("avg_check"),
                       round_half_up_ratio(F.col("_flights"), F.col("_nf")).alias("avg_flights_per_passenger"),
                       "total_revenue")
            .orderBy(F.asc_nulls_last("flight_date")))


# --- Q5 passenger groups -----------------------------------------------------------------
def passenger_window_stats(v, as_of, until=None, latest=False, revenue="booking_total") -> DataFrame:
    """Per passenger over the whole window: distinct flights and spend."""
    fw = flight_versions(v, as_of, until, latest)
    return _per_passenger(v, ticket_rows(v, fw, latest, revenue), flights="flights")


def passenger_groups_revenue(v, as_of, until=None, latest=False, revenue="booking_total") -> DataFrame:
    st = passenger_window_stats(v, as_of, until, latest, revenue)  # a passenger is one row
    grp = bucket_by_thresholds(F.col("flights"), GROUP_THRESHOLDS, GROUP_LABELS)
    g = (st.groupBy(grp.alias("passenger_group"))
         .agg(F.count("passenger_id").alias("passenger_count"),
              F.sum("total_spent").alias("group_revenue")))
    g = g.withColumn("_cents", cents(F.col("group_revenue")))
    out = share_of_total(g, "_cents", "revenue_share_percent").drop("_cents")
    return out.orderBy(F.desc_nulls_first("group_revenue"))


# --- KPI tiles and chart series ----------------------------------------------------------
def dashboard_kpis(v, as_of, until=None, latest=False) -> DataFrame:
    """K1-K4 from detail rows (distinct counts do not add up across days)."""
    k1 = active_airport_days(v, as_of, until, latest).agg(
        F.count_distinct("airport_code").alias("active_airports_30d"))
    st = passenger_window_stats(v, as_of, until, latest)
    k = st.agg(F.count(F.lit(1)).alias("unique_passengers_30d"),
               F.sum(cents(F.col("total_spent"))).alias("_cents"),
               F.sum("flights").alias("_flights"))
    k = k.select("unique_passengers_30d",
                 round_half_up_ratio(F.col("_cents"), F.col("unique_passengers_30d") * 100).alias("avg_check_30d"),
                 round_half_up_ratio(F.col("_flights"), F.col("unique_passengers_30d"))
                 .alias("avg_flights_per_passenger_30d"))
    return k1.crossJoin(k)  # one row by one row


def daily_series(v, as_of, until=None, latest=False) -> DataFrame:
    """K5: active airports, unique passengers and revenue per day (one row per day)."""
    a = active_airports_30d(v, as_of, until, latest)
    p = passenger_metrics_30d(v, as_of, until, latest).select("flight_date", "unique_passengers", "total_revenue")
    return (a.join(p, "flight_date", "full")
            .select("flight_date", F.coalesce("active_airports", F.lit(0)).alias("active_airports"),
                    F.coalesce("unique_passengers", F.lit(0)).alias("unique_passengers"),
                    "total_revenue")
            .orderBy(F.asc_nulls_last("flight_date")))


__all__ = ["active_airports_30d", "airport_traffic_share", "dashboard_kpis", "daily_series",
           "passenger_groups_revenue", "passenger_metrics_30d"]
