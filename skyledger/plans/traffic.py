"""`airport_traffic`: departures / arrivals and their passengers per airport.

Semantics (as the reference view computes them):
  departures  = COUNT(DISTINCT flight_id) of flights leaving the airport
  dep. pax    = number of ticket rows on those flights whose ticket exists
  arrivals / arr. pax the same for the arrival airport
  the two sides are FULL OUTER joined on the airport code, so an airport seen
  on one side only gets 0 on the other, and a NULL endpoint yields its own
  row on each side (NULL never matches NULL).

Plan: ticket rows are counted per flight first (partial aggregation before
the shuffle), so the fan-out flights x ticket_flights never travels. Each
flight is then emitted once per direction with `explode` and a single grouped
aggregate builds both sides; the FULL OUTER JOIN of two separately grouped
scans becomes one pass over flights.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def passengers_per_flight(ticket_flights: DataFrame, tickets: DataFrame | None) -> DataFrame:
    """`flight_id -> n`: ticket_flights rows that match a ticket (LEFT JOIN + COUNT(t.ticket_no)).

    `tickets=None` trusts the declared keys (ticket_no is the primary key of
    tickets and ticket_flights -> tickets holds; verify with
    `operators.quality.check_unique` / `check_foreign_key`): every row counts
    and the join of the two largest tables, with its two shuffles, is skipped.
    """
    if tickets is None:
        return ticket_flights.groupBy("flight_id").agg(F.count("ticket_no").alias("n_tickets"))
    t = tickets.select(F.col("ticket_no").alias("t_ticket_no"))
    return (ticket_flights.select("ticket_no", "flight_id")
            .join(t, F.col("ticket_no") == F.col("t_ticket_no"), "inner")
            .groupBy("flight_id").agg(F.count("t_ticket_no").alias("n_tickets")))


def airport_traffic(t: dict[str, DataFrame], trust_foreign_keys: bool = False) -> DataFrame:
    f = t["flights"].select("flight_id", "departure_airport", "arrival_airport")
    per_flight = passengers_per_flight(t["ticket_flights"], None if trust_foreign_keys else t["tickets"])
    legs = f.join(per_flight, "flight_id", "left")
    sides = legs.select(
        "flight_id",
        F.coalesce("n_tickets", F.lit(0)).alias("n"),
        F.explode(F.array(
            F.struct(F.col("departure_airport").alias("code"), F.lit("dep").alias("side")),
            F.struct(F.col("arrival_airport").alias("code"), F.lit("arr").alias("side")),
        )).alias("e"))
    per_side = (sides.groupBy(F.col("e.code").alias("airport_code"), F.col("e.side").alias("side"))
                .agg(F.count_distinct("flight_id").alias("flights"), F.sum("n").alias("pax")))
    # merge the two sides of one airport; a NULL code stays one row per side
    null_side = F.when(F.col("airport_code").isNull(), F.col("side"))
    dep, arr = F.col("side") == "dep", F.col("side") == "arr"
    return (per_side.groupBy("airport_code", null_side.alias("_null_side"))
            .agg(F.coalesce(F.sum(F.when(dep, F.col("flights"))), F.lit(0)).alias("departure_flights_num"),
                 F.coalesce(F.sum(F.when(dep, F.col("pax"))), F.lit(0)).alias("departure_psngr_num"),
                 F.coalesce(F.sum(F.when(arr, F.col("flights"))), F.lit(0)).alias("arrival_flights_num"),
                 F.coalesce(F.sum(F.when(arr, F.col("pax"))), F.lit(0)).alias("arrival_psngr_num"))
            .drop("_null_side"))
