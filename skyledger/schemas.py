"""Table schemas of the booking model, the history (Data Vault) layer and the marts.

Types follow the DDL: CHAR/VARCHAR/TEXT -> string (length limits become a
quality check), NUMERIC(10,2) -> decimal(10,2), TIMESTAMPTZ -> timestamp under a
UTC session, TIMESTAMP (no zone) -> timestamp as well, JSONB -> JSON text.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, TS, DT = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType(), T.DateType()
MONEY = T.DecimalType(10, 2)


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


OLTP = {
    "airports": _schema(("airport_code", S, False), ("airport_name", S, False), ("city", S, False),
                        ("coordinates_lon", D, False), ("coordinates_lat", D, False), ("timezone", S, False)),
    "aircrafts": _schema(("aircraft_code", S, False), ("model", S, False), ("range", I, False)),
    "seats": _schema(("aircraft_code", S, False), ("seat_no", S, False), ("fare_conditions", S, False)),
    "flights": _schema(("flight_id", I, False), ("flight_no", S, False), ("scheduled_departure", TS, False),
                       ("scheduled_arrival", TS, False), ("departure_airport", S, True),
                       ("arrival_airport", S, True), ("status", S, False), ("aircraft_code", S, True),
                       ("actual_departure", TS, True), ("actual_arrival", TS, True)),
    "bookings": _schema(("book_ref", S, False), ("book_date", TS, False), ("total_amount", MONEY, False)),
    "tickets": _schema(("ticket_no", S, False), ("book_ref", S, True), ("passenger_id", S, False),
                       ("passenger_name", S, False), ("contact_data", S, True)),
    "ticket_flights": _schema(("ticket_no", S, False), ("flight_id", I, False),
                              ("fare_conditions", MONEY, False), ("amount", MONEY, False)),
    "boarding_passes": _schema(("ticket_no", S, False), ("flight_id", I, False),
                               ("boarding_no", I, False), ("seat_no", S, False)),
}

# Declared constraints of the booking model: (table, key columns) and
# (child table, child columns, parent table, parent columns).
PRIMARY_KEYS = {
    "airports": ["airport_code"], "aircrafts": ["aircraft_code"], "seats": ["aircraft_code", "seat_no"],
    "flights": ["flight_id"], "bookings": ["book_ref"], "tickets": ["ticket_no"],
    "ticket_flights": ["ticket_no", "flight_id"], "boarding_passes": ["ticket_no", "flight_id"],
}
FOREIGN_KEYS = [
    ("seats", ["aircraft_code"], "aircrafts", ["aircraft_code"]),
    ("flights", ["departure_airport"], "airports", ["airport_code"]),
    ("flights", ["arrival_airport"], "airports", ["airport_code"]),
    ("flights", ["aircraft_code"], "aircrafts", ["aircraft_code"]),
    ("tickets", ["book_ref"], "bookings", ["book_ref"]),
    ("ticket_flights", ["ticket_no"], "tickets", ["ticket_no"]),
    ("ticket_flights", ["flight_id"], "flights", ["flight_id"]),
    ("boarding_passes", ["ticket_no", "flight_id"], "ticket_flights", ["ticket_no", "flight_id"]),
]
# Fixed width / maximum width of text columns (CHAR(n) / VARCHAR(n)).
TEXT_LIMITS = {
    "airports": {"airport_code": ("char", 3)},
    "aircrafts": {"aircraft_code": ("char", 3)},
    "seats": {"aircraft_code": ("char", 3), "seat_no": ("varchar", 4), "fare_conditions": ("varchar", 10)},
    "flights": {"flight_no": ("char", 6), "departure_airport": ("char", 3), "arrival_airport": ("char", 3),
                "status": ("varchar", 20), "aircraft_code": ("char", 3)},
    "bookings": {"book_ref": ("char", 6)},
    "tickets": {"ticket_no": ("char", 13), "book_ref": ("char", 6), "passenger_id": ("varchar", 20)},
    "ticket_flights": {"ticket_no": ("char", 13)},
    "boarding_passes": {"ticket_no": ("char", 13), "seat_no": ("varchar", 4)},
}

LINEAGE = [("load_date", TS, False), ("record_source", S, False), ("source_system_id", I, False)]

MARTS = {
    "frequent_flyers": _schema(("created_at", TS, False), ("passenger_id", S, False), ("passenger_name", S, False),
                               ("flights_number", I, False), ("purchase_sum", MONEY, False),
                               ("home_airport", S, False), ("customer_group", S, False)),
    "airport_passenger_flow": _schema(("created_at", TS, False), ("flight_date", DT, False),
                                      ("airport_code", S, False), ("linked_airport_code", S, False),
                                      ("flights_in", I, False), ("flights_out", I, False),
                                      ("passengers_in", I, False), ("passengers_out", I, False)),
}
MART_KEYS = {
    "frequent_flyers": ["passenger_id"],
    "airport_passenger_flow": ["flight_date", "airport_code", "linked_airport_code"],
}
