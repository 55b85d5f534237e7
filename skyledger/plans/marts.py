"""The two daily marts: airport passenger flow (Q7) and frequent flyers (Q6).

`build_*` returns the mart rows as a lazy DataFrame; `refresh_*` validates
and publishes them (validation first: parquet has no rollback).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import narrow
from ..operators.joins import swap_roles
from ..operators.quality import check_contract, check_not_empty, check_rules
from ..operators.ranking import tier_by_percent_rank
from ..operators.sinks import ensure_dataset, replace_partitions, upsert_table
from ..schemas import MART_KEYS, MARTS

FLOWN_STATUSES = ("Arrived", "Departed")
ROUTE = ["flight_date", "airport_code", "linked_airport_code"]


def _lit_date(d) -> Column:
    return F.lit(d).cast("date") if not isinstance(d, Column) else d


def _lit_ts(t) -> Column:
    return F.lit(t).cast("timestamp") if not isinstance(t, Column) else t


# --- Q7 airport passenger flow ---------------------------------------------------
def departures_on(flights: DataFrame, day) -> DataFrame:
    """Flown flights whose (actual, else scheduled) departure falls on `day` (UTC)."""
    dep_day = F.to_date(F.coalesce("actual_departure", "scheduled_departure"))
    return (flights.where(F.col("status").isin(*FLOWN_STATUSES) & (dep_day == _lit_date(day)))
            .select("flight_id", dep_day.alias("flight_date"),
                    F.col("departure_airport").alias("airport_code"),
                    F.col("arrival_airport").alias("linked_airport_code")))


def outbound_counts(t: dict[str, DataFrame], day) -> DataFrame:
    """Per route of `day`: flights_out (ticket rows, 1 for an empty flight, as the
    reference counts), flights_out_distinct and passengers_out (distinct tickets).

    The day's flights are the small side of the join (Spark broadcasts them
    where its own size figures allow); empty flights are found on it alone.
    """
    day_f = departures_on(t["flights"], day)
    matched = t["ticket_flights"].select("flight_id", "ticket_no").join(day_f, "flight_id")
    by_route = (matched.groupBy(*ROUTE)
                .agg(F.count(F.lit(1)).alias("_rows"),
                     F.count_distinct("ticket_no").alias("passengers_out"),
                     F.count_distinct("flight_id").alias("_nonempty")))
    flights = day_f.groupBy(*ROUTE).agg(F.count(F.lit(1)).alias("_flights"),
                                        F.count_distinct("flight_id").alias("flights_out_distinct"))
    j = flights.join(by_route, ROUTE, "left")
    return j.select(
        *ROUTE,
        (F.coalesce("_rows", F.lit(0)) + F.col("_flights") - F.coalesce("_nonempty", F.lit(0))).alias("flights_out"),
        "flights_out_distinct",
        F.coalesce("passengers_out", F.lit(0)).alias("passengers_out"))


def build_airport_passenger_flow(t: dict[str, DataFrame], as_of: dt.date, created_at=None,
                                 corrected: bool = False) -> DataFrame:
    """Rows of the passenger-flow mart for `as_of - 1 day`.

    as-written: flights_out counts ticket rows, only routes with outbound
    traffic appear (LEFT join of inbound). corrected: flights counted once,
    FULL OUTER join so inbound-only pairs appear too.
    """
    day = as_of - dt.timedelta(days=1)
    out = outbound_counts(t, day)
    if corrected:
        out = out.withColumn("flights_out", F.col("flights_out_distinct"))
    out = out.drop("flights_out_distinct")
    inbound = swap_roles(out, [("airport_code", "linked_airport_code")],
                         {"flights_out": "flights_in", "passengers_out": "passengers_in"})
    j = out.join(inbound, ROUTE, "full" if corrected else "left")
    created = _lit_ts(created_at) if created_at is not None else F.current_timestamp()
    return j.select(
        created.alias("created_at"), *ROUTE,
        *[narrow(F.coalesce(c, F.lit(0)), "int").alias(c) for c in ("flights_in", "flights_out", "passengers_in", "passengers_out")])


def check_mart(name: str):
    """Check of a mart's rows against its declared columns, NOT NULLs and key."""
    return lambda d: check_contract(d, MARTS[name], MART_KEYS[name])


def flow_rules() -> dict[str, Column]:
    return {
        "negative_counts": (F.col("flights_in") < 0) | (F.col("flights_out") < 0)
        | (F.col("passengers_in") < 0) | (F.col("passengers_out") < 0),
        "missing_airport": F.col("airport_code").isNull() | F.col("linked_airport_code").isNull(),
    }


def refresh_airport_passenger_flow(t: dict[str, DataFrame], target: str, as_of: dt.date,
                                   corrected: bool = False) -> DataFrame:
    """Validate the day's rows, then replace only that day's partition of `target`."""
    rows = build_airport_passenger_flow(t, as_of, corrected=corrected)
    ensure_dataset(rows.sparkSession, target, MARTS["airport_passenger_flow"], partition_by=["flight_date"])
    return replace_partitions(rows, target, ["flight_date"],
                              checks=[lambda d: check_rules(d, flow_rules()), check_not_empty,
                                      check_mart("airport_passenger_flow")],
                              sort_within=["airport_code", "linked_airport_code"])


# --- Q6 frequent flyers -------------------------------------------------------------
def passengers(tickets: DataFrame) -> DataFrame:
    """One row per passenger_id with the name on the passenger's latest ticket.

    The booking model has no passengers table; the name is taken from the
    highest ticket number (tickets are numbered in issue order).
    """
    return (tickets.groupBy("passenger_id")
            .agg(F.max_by("passenger_name", "ticket_no").alias("passenger_name")))


def flight_stats(t: dict[str, DataFrame], as_of: dt.date) -> DataFrame:
    """Per passenger over the last year of flown flights: flights_number,
    purchase_sum and home_airport (modal departure airport)."""
    since = F.add_months(_lit_date(as_of), -12).cast("timestamp")
    f = (t["flights"].where(F.col("status").isin(*FLOWN_STATUSES) & (F.col("scheduled_departure") >= since))
         .select("flight_id", "departure_airport",
                 F.coalesce("actual_departure", "scheduled_departure").alias("_dep_ts")))
    legs = (t["ticket_flights"].select("ticket_no", "flight_id", "amount")
            .join(f, "flight_id")
            .join(t["tickets"].select("ticket_no", "passenger_id"), "ticket_no"))
    # per (passenger, airport, flight): collapses repeated legs before any wide shuffle
    per_flight = (legs.groupBy("passenger_id", "departure_airport", "flight_id")
                  .agg(F.count(F.lit(1)).alias("_rows"), F.sum("amount").alias("_amount"),
                       F.max("_dep_ts").alias("_last")))
    per_airport = (per_flight.groupBy("passenger_id", "departure_airport")
                   .agg(F.sum("_rows").alias("_rows"), F.count(F.lit(1)).alias("_flights"),
                        F.sum("_amount").alias("_amount"), F.max("_last").alias("_last")))
    # one aggregate per passenger: totals plus the modal departure airport
    # (most ticket rows, then latest departure, then lowest code; NULL code last)
    home_key = F.struct((-F.col("_rows")).alias("c"), (-F.unix_micros("_last")).alias("t"),
                        F.col("departure_airport").isNull().alias("vn"), F.col("departure_airport").alias("v"))
    return (per_airport.groupBy("passenger_id")
            .agg(F.sum("_flights").alias("flights_number"), F.sum("_amount").alias("purchase_sum"),
                 F.min_by("departure_airport", home_key).alias("home_airport"))
            .where(F.col("flights_number") > 0))


def build_frequent_flyers(t: dict[str, DataFrame], as_of: dt.date, created_at=None, **rank_kw) -> DataFrame:
    stats = flight_stats(t, as_of)
    named = stats.join(passengers(t["tickets"]), "passenger_id", "left").withColumn(
        "passenger_name", F.coalesce("passenger_name", F.lit("Unknown")))
    tiered = tier_by_percent_rank(named, "purchase_sum", out="customer_group", **rank_kw)
    created = _lit_ts(created_at) if created_at is not None else F.current_timestamp()
    return tiered.select(created.alias("created_at"), "passenger_id", "passenger_name",
                         narrow(F.col("flights_number"), "int").alias("flights_number"),
                         narrow(F.col("purchase_sum"), "decimal(10,2)").alias("purchase_sum"),
                         "home_airport", "customer_group")


def flyer_rules() -> dict[str, Column]:
    return {
        "no_flights": F.col("flights_number") <= 0,
        "negative_sum": F.col("purchase_sum") < 0,
        "no_name": F.col("passenger_name").isNull(),
        "no_home_airport": F.col("home_airport").isNull(),
    }


def refresh_frequent_flyers(t: dict[str, DataFrame], target: str, as_of: dt.date, refresh: str = "upsert") -> DataFrame:
    """Validate, then upsert on passenger_id (as the reference does) or, with
    refresh="full", replace the whole table so lapsed passengers disappear."""
    rows = build_frequent_flyers(t, as_of)
    ensure_dataset(rows.sparkSession, target, MARTS["frequent_flyers"], versioned=True)
    return upsert_table(rows, target, ["passenger_id"], checks=[lambda d: check_rules(d, flyer_rules()), check_mart("frequent_flyers")],
                        full=(refresh == "full"), sort_within=["home_airport", "purchase_sum"])


__all__ = ["build_airport_passenger_flow", "build_frequent_flyers", "flight_stats", "outbound_counts", "passengers", "refresh_airport_passenger_flow", "refresh_frequent_flyers"]
