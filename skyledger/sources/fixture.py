"""Projection of the driver's TPC-H-style tables onto the airline booking model.

The booking model has eight OLTP tables (airports, aircrafts, seats, flights,
bookings, tickets, ticket_flights, boarding_passes). The test tables carry no
airline data, so each airline table is derived from one or two of them by a
fixed rule (FIXTURES.md §2). Every rule is a plain column expression, so the
derived tables are lazy DataFrames whose size grows with the inputs and whose
filters and projections Catalyst pushes into the parquet scans.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..lazy import LazyTables
from ..operators.sizing import shuffle_partitions

# Fixed values of the projection (FIXTURES.md §2). They must equal the ones in
# the SQL oracle for results to match.
DEFAULT_AS_OF = dt.date(2001, 8, 1)
FLIGHT_STATUS_BY_SIZE_MOD_5 = ["Arrived", "Arrived", "Departed", "Scheduled", "Cancelled"]
BOARDED_LINESTATUS = "F"

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def read_driver_tables(spark: SparkSession, sf_dir: str, names=DRIVER_TABLES) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names}


def _pad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def _book_ref(key: Column) -> Column:
    """Six-character code of an order key: its base-36 digits, an error beyond six of them."""
    code = F.lpad(F.conv(key.cast("string"), 10, 36), 6, "0")
    return F.when(key.between(0, 36 ** 6 - 1), code).when(
        key.isNotNull(), F.raise_error(F.concat(F.lit("order key outside six base-36 digits: "), key.cast("string"))).cast("string"))


def _airport(c: Column) -> Column:
    return F.concat(F.lit("A"), _pad(c, 2))


def _brand_no(p_brand: Column) -> Column:
    return F.split_part(p_brand, F.lit("#"), F.lit(2)).cast("int")


def airports(nation: DataFrame, region: DataFrame) -> DataFrame:
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .select(_airport(F.col("n_nationkey")).alias("airport_code"),
                    F.col("n_name").alias("airport_name"),
                    F.col("r_name").alias("city"),
                    (F.col("n_nationkey") * 7.0 - 90.0).cast("double").alias("coordinates_lon"),
                    (F.col("n_nationkey") * 3.0 - 40.0).cast("double").alias("coordinates_lat"),
                    F.lit("UTC").alias("timezone")))


def aircrafts(part: DataFrame) -> DataFrame:
    b = _brand_no(F.col("p_brand"))
    return (part.select("p_brand").distinct()
            .select(F.concat(F.lit("B"), _pad(b, 2)).alias("aircraft_code"),
                    F.concat(F.lit('{"en":"'), F.col("p_brand"), F.lit('"}')).alias("model"),
                    (F.lit(3000) + F.lit(100) * b).cast("int").alias("range")))


def flights(part: DataFrame, as_of: dt.date = DEFAULT_AS_OF) -> DataFrame:
    k = F.col("p_partkey")
    size = F.col("p_size")
    hub = (k % 4) == 0
    dep = F.when(hub, k % 25).otherwise(k % 5)
    arr = F.when(hub, (dep + 1 + size % 24) % 25).otherwise((dep + 1 + size % 4) % 5)
    status = F.element_at(F.array(*[F.lit(s) for s in FLIGHT_STATUS_BY_SIZE_MOD_5]),
                          (size % 5 + 1).cast("int"))
    day_offset = (F.lit(5) - k % 123 - F.when((k % 7) == 0, 400).otherwise(0)).cast("int")
    base = F.to_timestamp(F.lit(as_of.isoformat()))
    sched_dep = (base + F.make_dt_interval(day_offset, (size % 24).cast("int")))
    flown = status.isin("Arrived", "Departed")
    return (part.select(
        k.cast("int").alias("flight_id"),
        F.concat(F.lit("F"), _pad(k % 100000, 5)).alias("flight_no"),
        sched_dep.alias("scheduled_departure"),
        (sched_dep + F.expr("INTERVAL 2 HOURS")).alias("scheduled_arrival"),
        _airport(dep).alias("departure_airport"),
        _airport(arr).alias("arrival_airport"),
        status.alias("status"),
        F.concat(F.lit("B"), _pad(_brand_no(F.col("p_brand")), 2)).alias("aircraft_code"),
        F.when(flown, sched_dep + F.make_dt_interval(F.lit(0), F.lit(0), size)).alias("actual_departure"),
        F.when(status == "Arrived",
               sched_dep + F.expr("INTERVAL 2 HOURS") + F.make_dt_interval(F.lit(0), F.lit(0), size))
         .alias("actual_arrival"),
    ))


def bookings(orders: DataFrame) -> DataFrame:
    return orders.select(_book_ref(F.col("o_orderkey")).alias("book_ref"),
                         F.col("o_orderdate").cast("timestamp").alias("book_date"),
                         F.col("o_totalprice").cast("decimal(10,2)").alias("total_amount"))


def tickets(orders: DataFrame, customer: DataFrame) -> DataFrame:
    return (orders.join(customer, orders.o_custkey == customer.c_custkey)
            .select(_pad(F.col("o_orderkey"), 13).alias("ticket_no"),
                    _book_ref(F.col("o_orderkey")).alias("book_ref"),
                    F.col("c_custkey").cast("string").alias("passenger_id"),
                    F.col("c_name").alias("passenger_name"),
                    F.concat(F.lit('{"segment":"'), F.col("c_mktsegment"), F.lit('"}')).alias("contact_data")))


def _legs(lineitem: DataFrame, *columns: str):
    """Every (order, part) pair is a ticket leg. The lines are brought together by the leg's own key columns, in as many
    partitions as their size asks, so that the grouping and a join on them follow without another shuffle."""
    return (lineitem.select(_pad(F.col("l_orderkey"), 13).alias("ticket_no"), F.col("l_partkey").cast("int").alias("flight_id"), *columns)
            .repartition(shuffle_partitions(lineitem), "ticket_no", "flight_id").groupBy("ticket_no", "flight_id"))


def ticket_flights(lineitem: DataFrame) -> DataFrame:
    return (_legs(lineitem, "l_tax", "l_extendedprice")
            .agg(F.min("l_tax").cast("decimal(10,2)").alias("fare_conditions"),
                 F.sum(F.col("l_extendedprice").cast("decimal(10,2)")).cast("decimal(10,2)").alias("amount")))


def boarding_passes(lineitem: DataFrame) -> DataFrame:
    """One pass for each leg that was boarded (a line of it has the boarded status)."""
    boarded = lineitem.where(F.col("l_linestatus") == BOARDED_LINESTATUS)
    return (_legs(boarded, "l_linenumber", "l_quantity")
            .agg(F.min("l_linenumber").alias("boarding_no"), F.min("l_quantity").alias("q"))
            .where(F.col("boarding_no").isNotNull())
            .select("ticket_no", "flight_id",
                    F.col("boarding_no").cast("int").alias("boarding_no"),
                    F.concat(F.col("q").cast("int").cast("string"), F.lit("A")).alias("seat_no")))


def seats(aircraft: DataFrame, rows_per_aircraft: int = 4) -> DataFrame:
    """Seat map per aircraft (schema checks only; nothing in the reference reads it)."""
    fares = F.array(F.lit("Economy"), F.lit("Comfort"), F.lit("Business"))
    return (aircraft.select("aircraft_code", F.explode(F.sequence(F.lit(1), F.lit(rows_per_aircraft))).alias("r"))
            .select("aircraft_code",
                    F.concat(F.col("r").cast("string"), F.lit("A")).alias("seat_no"),
                    F.element_at(fares, ((F.col("r") - 1) % 3 + 1).cast("int")).alias("fare_conditions")))


def airline_tables(spark: SparkSession, sf_dir: str, as_of: dt.date = DEFAULT_AS_OF) -> LazyTables:
    """All eight booking-model tables, derived lazily from the driver tables
    (each table's plan is built on first use)."""
    d = LazyTables({n: (lambda n=n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet"))
                    for n in ("region", "nation", "customer", "part", "orders", "lineitem")})
    out: LazyTables

    def ac():
        return aircrafts(d["part"])
    out = LazyTables({
        "airports": lambda: airports(d["nation"], d["region"]),
        "aircrafts": ac,
        "seats": lambda: seats(out["aircrafts"]),
        "flights": lambda: flights(d["part"], as_of),
        "bookings": lambda: bookings(d["orders"]),
        "tickets": lambda: tickets(d["orders"], d["customer"]),
        "ticket_flights": lambda: ticket_flights(d["lineitem"]),
        "boarding_passes": lambda: boarding_passes(d["lineitem"]),
    })
    return out


# --- change feed from `events` (FIXTURES.md §3) ---------------------------------------
# Operation per event type.
EVENT_OPS = {"signup": "c", "click": "u", "purchase": "u", "error": "d", "view": "r"}


def airport_image(events: DataFrame) -> Column:
    code = _airport(F.col("user_id") % 25)
    return F.struct(code.alias("airport_code"),
                    F.concat(F.lit("Airport "), code).alias("airport_name"),
                    F.concat(F.lit("City "), F.col("event_type")).alias("city"),
                    F.col("value").alias("coordinates_lon"),
                    (-F.col("value")).alias("coordinates_lat"),
                    F.lit("UTC").alias("timezone"))


def aircraft_image(events: DataFrame) -> Column:
    return F.struct(F.concat(F.lit("B"), _pad(F.col("user_id") % 25, 2)).alias("aircraft_code"),
                    F.concat(F.lit('{"en":"'), F.col("event_type"), F.lit('"}')).alias("model"),
                    (F.col("user_id") * 10).cast("int").alias("range"))


def change_feed(events: DataFrame, prefix: str = "airline.public", partitions: int = 8) -> DataFrame:
    """Kafka-like change messages: every event becomes one airports message and
    one aircrafts message, offset = event_id, message time = event ts.

    Like a keyed topic, messages are numbered into `partitions` topic partitions
    by a hash of their key; Spark's own split of the input stays as it is read.
    """
    op = F.try_element_at(F.create_map(*[F.lit(x) for kv in EVENT_OPS.items() for x in kv]), F.col("event_type"))

    def envelope(img: Column) -> Column:
        after = F.when(op != "d", img)
        before = F.when(op.isin("u", "d"), img)
        return F.to_json(F.struct(F.struct(op.alias("op"), before.alias("before"), after.alias("after"),
                                           (F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("long")
                                           .alias("ts_ms")).alias("payload")))

    key = F.col("user_id").cast("string")
    part = F.pmod(F.hash(key), F.lit(partitions)).cast("int")
    msgs = F.array(
        F.struct(F.lit(f"{prefix}.airports").alias("topic"), envelope(airport_image(events)).alias("value")),
        F.struct(F.lit(f"{prefix}.aircrafts").alias("topic"), envelope(aircraft_image(events)).alias("value")),
    )
    keyed = events.select("event_id", "ts", "user_id", "event_type", "value",
                          part.alias("partition"))
    return (keyed.select("event_id", "ts", "user_id", "partition", F.explode(msgs).alias("m"))
            .select(F.col("m.topic").alias("topic"), "partition",
                    F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"),
                    F.col("user_id").cast("string").alias("key"), F.col("m.value").alias("value")))


def ticket_flights_snapshot(lineitem: DataFrame, returnflags=("N",)) -> DataFrame:
    """ticket_flights as it would look with legs of the given return flags
    (two flag sets give two snapshots of one table for change detection)."""
    lines = lineitem.where(F.col("l_returnflag").isin(*returnflags)).select("l_orderkey", "l_partkey", "l_tax", "l_extendedprice")
    return (lines.repartition(shuffle_partitions(lineitem), "l_orderkey", "l_partkey").groupBy("l_orderkey", "l_partkey")
            .agg(F.min("l_tax").cast("decimal(10,2)").alias("fare_conditions"),
                 F.sum(F.col("l_extendedprice").cast("decimal(10,2)")).cast("decimal(10,2)").alias("amount"))
            .select(_pad(F.col("l_orderkey"), 13).alias("ticket_no"),
                    F.col("l_partkey").cast("int").alias("flight_id"), "fare_conditions", "amount"))


# Return flags of the two ticket_flights snapshots.
SNAPSHOT_OLD_FLAGS = ("N", "A")
SNAPSHOT_NEW_FLAGS = ("N", "R")
