"""Registered queries: one callable `(spark, sf_dir) -> DataFrame` per query/operator.

Each one reads the driver tables of `sf_dir`, projects them onto the booking
model (sources.fixture) and runs a plan or an operator from this package over
the whole tables. Output is presented engine-neutrally (see `portable`) so it
can be compared value by value with the SQL in `skyledger.oracle`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .plans import daily, dashboards, marts, traffic, vault
from .session import apply_required_conf, scratch_path
from .functions import keys
from .lazy import LazyTables
from .operators import joins, quality, ranking, sinks
from .plans import checks, views
from .schemas import MARTS, PRIMARY_KEYS
from .sources import cdc, fixture
from .streaming import vault_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def portable(df: DataFrame) -> DataFrame:
    """Dates / timestamps as ISO text, decimals as double, binary ids as hex text (shared output convention)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.BinaryType):
            c = F.lower(F.hex(c))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def register(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_required_conf(spark)
            return portable(fn(spark, sf_dir))
        run.__name__ = f"q_{name}"
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


AS_OF = fixture.DEFAULT_AS_OF
LOAD_TS = "2001-08-01 00:00:00"  # pinned load / creation time of every registered output


def _airline(spark, sf_dir):
    return fixture.airline_tables(spark, sf_dir, AS_OF)


@register("airport_traffic")
def _q1(spark, sf_dir):
    """Q1: departures/arrivals and their passengers per airport."""
    return traffic.airport_traffic(_airline(spark, sf_dir))


@register("airport_traffic_trusted_keys")
def _q1_trusted(spark, sf_dir):
    """Q1 without the ticket-existence join, for tables whose declared keys were
    verified when they were loaded (`quality_report` checks them)."""
    t = _airline(spark, sf_dir)
    return traffic.airport_traffic(t, trust_foreign_keys=True)


@register("airport_passenger_flow")
def _q7(spark, sf_dir):
    """Q7: passenger-flow mart rows for as_of - 1 day, as the reference computes them."""
    return marts.build_airport_passenger_flow(_airline(spark, sf_dir), AS_OF, created_at=LOAD_TS)


@register("airport_passenger_flow_corrected")
def _q7c(spark, sf_dir):
    """Q7 corrected: flights counted once, inbound-only routes kept (FULL OUTER)."""
    return marts.build_airport_passenger_flow(_airline(spark, sf_dir), AS_OF, created_at=LOAD_TS, corrected=True)


@register("frequent_flyers")
def _q6(spark, sf_dir):
    """Q6: frequent-flyer mart rows (flights, spend, home airport, percentile tier)."""
    return marts.build_frequent_flyers(_airline(spark, sf_dir), AS_OF, created_at=LOAD_TS)


# --- history layer L1-L14 ----------------------------------------------------------
def _vault(spark, sf_dir):
    return vault.build_vault(_airline(spark, sf_dir), LOAD_TS)


def _register_vault_table(name: str) -> None:
    def q(spark, sf_dir):
        return _vault(spark, sf_dir)[name]
    q.__doc__ = f"History layer: batch load of {name} from the booking model."
    register(name)(q)


for _name in vault.TABLES:
    _register_vault_table(_name)


# --- dashboards Q2-Q5, KPI tiles K1-K5 -----------------------------------------------
@register("active_airports_30d")
def _q2(spark, sf_dir):
    """Q2: active airports per day over the last 30 days."""
    return dashboards.active_airports_30d(_vault(spark, sf_dir), AS_OF)


@register("airport_traffic_share")
def _q3(spark, sf_dir):
    """Q3: flights / passengers per airport and their share of the total."""
    return dashboards.airport_traffic_share(_vault(spark, sf_dir), AS_OF)


@register("passenger_metrics_30d")
def _q4(spark, sf_dir):
    """Q4: unique passengers, average check, flights per passenger and revenue per day."""
    return dashboards.passenger_metrics_30d(_vault(spark, sf_dir), AS_OF)


@register("passenger_groups_revenue")
def _q5(spark, sf_dir):
    """Q5: passengers and revenue per frequency group, with revenue share."""
    return dashboards.passenger_groups_revenue(_vault(spark, sf_dir), AS_OF)


@register("dashboard_kpis")
def _k14(spark, sf_dir):
    """K1-K4: 30-day KPI tiles computed from detail rows."""
    return dashboards.dashboard_kpis(_vault(spark, sf_dir), AS_OF)


@register("daily_dashboard_series")
def _k5(spark, sf_dir):
    """K5: per-day chart series (active airports, unique passengers, revenue)."""
    return dashboards.daily_series(_vault(spark, sf_dir), AS_OF)


def _stored_history(spark, sf_dir):
    """The history layer loaded in four batches (airports, fleet and flights; bookings; tickets; legs), then compacted,
    as a reader of the store finds it."""
    def load(root):
        t = _airline(spark, sf_dir)
        parts = [["hub_airports", "hub_aircrafts", "hub_flights", "link_flight_leg", "sat_airport_details", "sat_aircraft_details", "sat_flight_details"],
                 ["hub_bookings", "sat_booking_details"], ["hub_passengers", "sat_passenger_details", "link_ticket_booking"],
                 ["link_ticket_flight", "sat_ticket_flight_details"]]
        for i, tables in enumerate(parts):
            vault.load_vault(spark, t, root, i, LOAD_TS, tables=tables)
        vault.compact_vault(spark, root, fan=3)
    return vault.read_vault(spark, _stored_once(spark, sf_dir, "history", load))


def _dashboard_stored(name, build):
    def q(spark, sf_dir):
        return build(_stored_history(spark, sf_dir), AS_OF)
    q.__doc__ = f"{name} over the stored, compacted history layer."
    register(f"{name}_stored")(q)


for _name, _build in (("active_airports_30d", dashboards.active_airports_30d), ("airport_traffic_share", dashboards.airport_traffic_share),
                      ("passenger_metrics_30d", dashboards.passenger_metrics_30d), ("passenger_groups_revenue", dashboards.passenger_groups_revenue),
                      ("dashboard_kpis", dashboards.dashboard_kpis), ("daily_dashboard_series", dashboards.daily_series)):
    _dashboard_stored(_name, _build)


def _stored_days(spark, sf_dir):
    """Day partials of the stored history after three runs: the first 29 days, the next day alone, all later ones."""
    def load(root):
        v = _stored_history(spark, sf_dir)
        first = AS_OF - dt.timedelta(days=dashboards.WINDOW_DAYS)
        for since, until in ((first, AS_OF - dt.timedelta(days=1)), (AS_OF - dt.timedelta(days=1), AS_OF), (AS_OF, None)):
            daily.refresh_days(v, root, since, until)
    return daily.read_days(spark, _stored_once(spark, sf_dir, "days", load), AS_OF)


def _dashboard_days(name, build):
    def q(spark, sf_dir):
        return build(_stored_days(spark, sf_dir))
    q.__doc__ = f"{name} combined from stored day partials."
    register(f"{name}_from_days")(q)


for _name, _build in (("active_airports_30d", daily.active_airports), ("passenger_metrics_30d", daily.passenger_metrics),
                      ("passenger_groups_revenue", daily.passenger_groups), ("dashboard_kpis", daily.kpis), ("daily_dashboard_series", daily.series)):
    _dashboard_days(_name, _build)


@register("stopped_load_shows_nothing")
def _stopped(spark, sf_dir):
    """Rows per history table seen after a finished batch and one that stopped after writing its tables, and after
    its repetition."""
    t, root = _airline(spark, sf_dir), scratch_path(spark, "stopped-load")
    vault.load_vault(spark, t, root, 0, LOAD_TS, tables=["hub_airports", "hub_aircrafts", "hub_flights", "sat_flight_details"])
    late = ["hub_bookings", "sat_booking_details", "hub_passengers", "link_ticket_booking"]

    def counts(column):
        out = None
        for name, rows in vault.read_vault(spark, root).items():
            n = rows.agg(F.count(F.lit(1)).alias(column)).select(F.lit(name).alias("table_name"), column)
            out = n if out is None else out.unionByName(n)
        return out
    vault.write_batch(vault.begin_batch(spark, root, "batch", 1), t, LOAD_TS, tables=late)
    stopped = sinks.materialise(counts("rows_after_stop"))
    vault.load_vault(spark, t, root, 1, LOAD_TS, tables=late)
    return (counts("rows_after_repeat").join(stopped, "table_name", "left")
            .select("table_name", F.coalesce("rows_after_stop", F.lit(0)).alias("rows_after_stop"), "rows_after_repeat"))


@register("sql_view_passenger_groups")
def _view(spark, sf_dir):
    """Q5 and Q1 through their SQL views: each group next to the number of airports with departures."""
    views.create_views(spark, _airline(spark, sf_dir), _vault(spark, sf_dir), AS_OF, prefix="sky_")
    return spark.sql("""
        SELECT passenger_group, passenger_count, group_revenue,
               (SELECT count(*) FROM sky_airport_traffic WHERE departure_flights_num > 0) AS departure_airports
        FROM sky_passenger_groups_revenue""")


# --- change capture ---------------------------------------------------------------------
def _feed(spark, sf_dir):
    return fixture.change_feed(spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet"))


def _msg_cols(df):
    return [F.col("_op").alias("op"), F.col("_offset").alias("offset"), F.col("_load_ts").alias("message_ts")]


@register("cdc_airport_changes")
def _cdc_changes(spark, sf_dir):
    """Parsed change messages of the airports topic: op, offset, typed image."""
    ch = cdc.parse_changes(_feed(spark, sf_dir))
    img = cdc.typed_images(ch, "airports")
    return img.select(*_msg_cols(img), "airport_code", "airport_name", "city", "coordinates_lon",
                      "coordinates_lat", "timezone")


def _cdc_table(name):
    def q(spark, sf_dir):
        return vault_stream.batch_load_from_feed(spark, _feed(spark, sf_dir))[name]
    q.__doc__ = f"{name} rows one change-feed batch loads into an empty history layer."
    register(f"cdc_{name}")(q)


for _name in ("hub_airports", "sat_airport_details", "hub_aircrafts", "sat_aircraft_details"):
    _cdc_table(_name)


_STORED: dict[tuple, str] = {}


def _stored_once(spark, sf_dir, name: str, load) -> str:
    """Folder of a stored layer that several queries read: `load(root)` runs once per session and input."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        root = scratch_path(spark, name)
        load(root)
        _STORED[key] = root
    return _STORED[key]


def _feed_of(t, names) -> DataFrame:
    """All rows of some tables as created messages. Their offsets hold once they are written."""
    feed = None
    for n in names:
        part = cdc.to_envelopes(cdc.snapshot_diff(t[n].limit(0), t[n], PRIMARY_KEYS[n]), n)
        feed = part if feed is None else feed.unionByName(part)
    return feed


def _legs_before_tickets(spark, sf_dir):
    """History layer after two change batches over all bookings: the legs and their passes first, the
    bookings, tickets and flights they wait for second."""
    def load(root):
        t = _airline(spark, sf_dir)
        groups = (("ticket_flights", "boarding_passes"), ("bookings", "tickets", "flights"))
        names = [n for g in groups for n in g]
        for i, group in enumerate(groups):
            vault_stream.load_changes_batch(_feed_of(t, group), i, root, names)
    return vault.read_vault(spark, _stored_once(spark, sf_dir, "cdc-legs", load))


def _cdc_stored(name):
    def q(spark, sf_dir):
        return _legs_before_tickets(spark, sf_dir)[name].drop("load_date")
    q.__doc__ = f"{name} loaded from a change feed of all bookings, whose legs come a batch before their tickets and flights."
    register(f"cdc_{name}")(q)


for _name in ("link_ticket_flight", "sat_ticket_flight_details", "hub_passengers", "hub_bookings", "hub_flights", "link_flight_leg",
              "link_ticket_booking", "sat_passenger_details", "sat_booking_details", "sat_flight_details"):
    _cdc_stored(_name)


@register("cdc_redelivered_feed")
def _redelivered(spark, sf_dir):
    """Airport details of a stream whose messages come again: in the same batch, in the next one after a restart
    on the checkpoint, and whole to a second stream on a new checkpoint."""
    feed, root = _feed(spark, sf_dir), scratch_path(spark, "cdc-again")
    early = F.pmod(F.xxhash64("topic", "partition", "offset"), F.lit(2)) == 0

    def deliver(rows):
        rows.write.mode("append").parquet(f"{root}/feed")

    def stream(checkpoint):
        source = cdc.cdc_source(spark, "parquet", f"{root}/feed")
        q = vault_stream.start_vault_stream(source, f"{root}/vault", f"{root}/{checkpoint}", tables=["airports"])
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    deliver(feed.where(early))
    deliver(feed.where(early & (F.col("offset") % 3 == 0)))
    stream("one")
    deliver(feed.where(~early))
    deliver(feed.where(F.col("offset") % 5 == 0))
    stream("one")
    stream("two")
    return vault.read_vault(spark, f"{root}/vault")["sat_airport_details"]


@register("cdc_quarantine")
def _quarantine(spark, sf_dir):
    """Rejects of a change feed of bookings in which some messages are cut short, carry no payload, or an image
    without its key or with an amount that is no number."""
    t = _airline(spark, sf_dir)
    feed = cdc.to_envelopes(cdc.snapshot_diff(t["bookings"].limit(0), t["bookings"], PRIMARY_KEYS["bookings"]), "bookings")
    ref = F.get_json_object("value", "$.payload.after.book_ref")
    turn = (F.get_json_object("value", "$.payload.after.total_amount").cast("decimal(10,2)") * 100).cast("long") % 50
    value = (F.when(turn == 0, F.substring("value", 1, 20)).when(turn == 1, F.lit("{}"))
             .when(turn == 2, F.regexp_replace("value", '"book_ref":"[^"]*",?', "")).when(turn == 3, F.regexp_replace("value", r'"total_amount":[0-9.]+', '"total_amount":"none"'))
             .when(turn == 4, F.lit(None)).otherwise(F.col("value")))
    feed = sinks.materialise(feed.withColumn("key", ref).withColumn("value", value))
    rejects = cdc.quarantine(feed).unionByName(cdc.image_rejects(cdc.parse_changes(feed), ["bookings"], decimals="text"))
    return rejects.join(feed.select("offset", F.col("key").alias("book_ref")), "offset").select("book_ref", "reject_reason")


@register("cdc_sat_airport_details_with_snapshot")
def _cdc_snapshot(spark, sf_dir):
    """Airport details of the same feed with its snapshot reads (op r) loaded as well."""
    return vault_stream.batch_load_from_feed(spark, _feed(spark, sf_dir), include_snapshot=True)["sat_airport_details"]


@register("cdc_booking_amounts")
def _cdc_amounts(spark, sf_dir):
    """Booking amounts read from a change feed that carries NUMERIC as base64 of the unscaled integer."""
    b = _airline(spark, sf_dir)["bookings"]
    encoded = b.withColumn("total_amount", cdc.encode_decimal(F.col("total_amount"), 2))
    feed = sinks.materialise(_feed_of({"bookings": encoded}, ["bookings"]))
    img = cdc.typed_images(cdc.parse_changes(feed), "bookings", decimals="base64")
    return img.select("book_ref", "book_date", "total_amount")


@register("frequent_flyers_full_refresh")
def _full_refresh(spark, sf_dir):
    """Stored frequent-flyer table after an upsert of the July run and a full refresh
    with the August one, read back: passengers that lapsed are gone."""
    t, target = _airline(spark, sf_dir), scratch_path(spark, "frequent-flyers")
    july = marts.build_frequent_flyers(t, dt.date(2001, 7, 1), created_at="2001-07-01 00:00:00")
    sinks.upsert_table(july, target, ["passenger_id"])
    sinks.upsert_table(marts.build_frequent_flyers(t, AS_OF, created_at=LOAD_TS), target, ["passenger_id"], full=True)
    return sinks.read_current(spark, target)


@register("changed_versions_aircrafts")
def _changed(spark, sf_dir):
    """Which aircraft change images differ from their predecessor (message order) of the same aircraft."""
    img = cdc.typed_images(cdc.parse_changes(_feed(spark, sf_dir)), "aircrafts").where("_op <> 'd'")
    rows = img.select("aircraft_code", F.col("_offset").alias("offset"), "model", "range",
                      keys.hash_columns(img, ["aircraft_code", "model", "range"]).alias("hash_diff"))
    return ranking.mark_changes(rows, "aircraft_code", "offset").select("aircraft_code", "offset", "is_change")


@register("hash_compat_airports")
def _hash_compat(spark, sf_dir):
    """Record hash of each airports change image in the reference's encoding."""
    img = cdc.typed_images(cdc.parse_changes(_feed(spark, sf_dir)), "airports")
    cols = ["airport_code", "airport_name", "city", "coordinates_lon", "coordinates_lat", "timezone"]
    return img.select(F.col("_offset").alias("offset"), F.col("_op").alias("op"),
                      keys.hash_columns(img, cols, compat=True).alias("record_hash"),
                      keys.hash_columns(img, cols).alias("record_hash_delimited"))


@register("snapshot_diff_ticket_flights")
def _snap(spark, sf_dir):
    """Change feed between two snapshots of ticket_flights (c / u / d)."""
    li = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    old = fixture.ticket_flights_snapshot(li, fixture.SNAPSHOT_OLD_FLAGS)
    new = fixture.ticket_flights_snapshot(li, fixture.SNAPSHOT_NEW_FLAGS)
    d = cdc.snapshot_diff(old, new, ["ticket_no", "flight_id"])
    return d.select("op", "ticket_no", "flight_id",
                    F.col("before.fare_conditions").alias("before_fare_conditions"),
                    F.col("before.amount").alias("before_amount"),
                    F.col("after.fare_conditions").alias("after_fare_conditions"),
                    F.col("after.amount").alias("after_amount"))


# --- reusable operators over the whole tables ---------------------------------------------
@register("either_endpoint_join_flights")
def _op_either(spark, sf_dir):
    """Airports joined to every flight that departs from or arrives at them (OR join)."""
    t = _airline(spark, sf_dir)
    j = joins.either_endpoint_join(t["airports"].select("airport_code"), "airport_code",
                                   t["flights"].select("flight_id", "departure_airport", "arrival_airport"),
                                   "departure_airport", "arrival_airport")
    return j.select("airport_code", "flight_id")


@register("modal_departure_airport")
def _op_modal(spark, sf_dir):
    """Most used departure airport per passenger over all flights (ties: latest, then code)."""
    t = _airline(spark, sf_dir)
    legs = (t["ticket_flights"].select("ticket_no", "flight_id")
            .join(t["flights"].select("flight_id", "departure_airport",
                                      F.coalesce("actual_departure", "scheduled_departure").alias("dep_ts")),
                  "flight_id")
            .join(t["tickets"].select("ticket_no", "passenger_id"), "ticket_no"))
    return ranking.modal_value(legs, ["passenger_id"], "departure_airport", "dep_ts", out="modal_airport")


@register("booking_percentile_tiers")
def _op_tiers(spark, sf_dir):
    """Percent rank of every booking by total amount (descending) and its tier label."""
    b = _airline(spark, sf_dir)["bookings"].select("book_ref", "total_amount")
    ranked = ranking.percent_rank(b, "total_amount", descending=True, out="percent_rank")
    return ranked.withColumn("tier", ranking.bucket_by_thresholds(
        F.col("percent_rank"), (0.05, 0.10, 0.25, 0.50), ("5", "10", "25", "50", "50+"), upper_inclusive=True))


@register("departure_share")
def _op_share(spark, sf_dir):
    """Each airport's share of all departures (exact half-up percentage)."""
    tr = traffic.airport_traffic(_airline(spark, sf_dir)).select("airport_code", "departure_flights_num")
    return ranking.share_of_total(tr, "departure_flights_num", "departure_share_percent")


@register("insert_if_absent_passengers")
def _op_insert(spark, sf_dir):
    """Passenger hub rows an incremental load adds: passengers of all tickets not
    yet in a hub loaded from bookings made before 2000 (anti-join insert)."""
    t = _airline(spark, sf_dir)
    early = t["tickets"].join(t["bookings"].where(F.col("book_date") < F.lit("2000-01-01").cast("timestamp"))
                              .select("book_ref"), "book_ref", "left_semi")
    hub = vault.HUB_BY_NAME["hub_passengers"]
    target = vault.build_hub(hub, early, LOAD_TS)
    rows = vault.build_hub(hub, t["tickets"], LOAD_TS)
    return sinks.insert_if_absent(target, rows, [hub.hash_col])


@register("upsert_frequent_flyers")
def _op_upsert(spark, sf_dir):
    """Mart after two runs: run of 2001-07-01 upserted with the run of 2001-08-01."""
    t = _airline(spark, sf_dir)
    earlier = marts.build_frequent_flyers(t, dt.date(2001, 7, 1), created_at="2001-07-01 00:00:00")
    latest = marts.build_frequent_flyers(t, AS_OF, created_at=LOAD_TS)
    return sinks.upsert(earlier, latest, ["passenger_id"])


@register("table_diff_ticket_flights")
def _op_diff(spark, sf_dir):
    """Multiset difference of two ticket_flights snapshots, tagged by side."""
    li = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    a = fixture.ticket_flights_snapshot(li, fixture.SNAPSHOT_OLD_FLAGS)
    b = fixture.ticket_flights_snapshot(li, fixture.SNAPSHOT_NEW_FLAGS)
    return quality.table_diff(a, b)


@register("table_diff_by_digest_ticket_flights")
def _op_digest(spark, sf_dir):
    """The same difference, found by comparing digests of key buckets first."""
    li = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    a = fixture.ticket_flights_snapshot(li, fixture.SNAPSHOT_OLD_FLAGS)
    b = fixture.ticket_flights_snapshot(li, fixture.SNAPSHOT_NEW_FLAGS)
    return quality.table_diff_by_digest(a, b, PRIMARY_KEYS["ticket_flights"])


@register("quality_report")
def _op_quality(spark, sf_dir):
    """Declared-constraint violations of the booking model: duplicate primary keys,
    foreign-key orphans, NOT NULL and text-length violations (one row per check)."""
    t = _airline(spark, sf_dir)
    return checks.constraint_report(t)


@register("constraint_violations_legs")
def _op_violations(spark, sf_dir):
    """The same checks where they are broken: ticket legs of one snapshot against boarding
    passes and flights of others, with keys that repeat and limits that are passed."""
    li = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    t = {"legs": fixture.ticket_flights_snapshot(li, fixture.SNAPSHOT_OLD_FLAGS),
         "later_legs": fixture.ticket_flights_snapshot(li, fixture.SNAPSHOT_NEW_FLAGS),
         "passes": fixture.boarding_passes(li)}
    return quality.violation_report(t, quality.Constraints(
        keys=[("pk:legs", "legs", ["ticket_no", "flight_id"]), ("pk:legs.ticket_no", "legs", ["ticket_no"]),
              ("pk:passes.seat", "passes", ["flight_id", "seat_no"])],
        references=[("fk:passes.leg", "passes", ["ticket_no", "flight_id"], "legs", ["ticket_no", "flight_id"]),
                    ("fk:legs.later", "legs", ["ticket_no", "flight_id"], "later_legs", ["ticket_no", "flight_id"]),
                    ("fk:later.ticket", "later_legs", ["ticket_no"], "legs", ["ticket_no"])],
        rules=[("col:passes.seat_length", "passes", F.length("seat_no") > 2),
               ("col:legs.amount", "legs", F.col("amount") > 50000), ("col:legs.ticket_null", "legs", F.col("ticket_no").isNull())]))


@register("flow_mart_rule_counts")
def _op_rules(spark, sf_dir):
    """Violation counts of the passenger-flow mart's publish rules."""
    rows = marts.build_airport_passenger_flow(_airline(spark, sf_dir), AS_OF, created_at=LOAD_TS)
    return quality.rule_counts(rows, marts.flow_rules())


# --- satellites with two versions (as-written fan-out vs latest version) -------------------
def _two_load_vault(spark, sf_dir):
    return _two_loads(fixture.airline_tables(spark, sf_dir, dt.date(2001, 7, 31)), "2001-07-31 00:00:00", _airline(spark, sf_dir), LOAD_TS)


def _two_loads(t1, ts1, t2, ts2):
    """History tables after two loads. Hubs and links are compared by their business keys, which are a fraction of the
    digests made of them: digests are made of what is new only."""
    first, second = vault.build_vault(t1, ts1), vault.build_vault(t2, ts2)
    s1, s2 = vault.sources(t1), vault.sources(t2)

    def combined(name):
        if name.startswith("sat_"):
            return first[name].unionByName(second[name])
        if name in vault.HUB_BY_NAME:
            h = vault.HUB_BY_NAME[name]
            new = sinks.insert_if_absent(s1[h.source].select(h.key).distinct(), s2[h.source].select(h.key).distinct(), [h.key], unique=True)
            return first[name].unionByName(vault.build_hub(h, new, ts2))
        lk = vault.LINK_BY_NAME[name]
        # repeated keys, if any, are dropped when the link is built of what is left
        k1, k2 = (vault.link_source(lk, s).select(*lk.key_cols) for s in (s1, s2))
        new = sinks.insert_if_absent(k1, k2, lk.key_cols, unique=True, nulls_match=True)
        return first[name].unionByName(vault.build_link(lk, new, ts2))
    return LazyTables({n: (lambda n=n: combined(n)) for n in vault.TABLES})


@register("airport_traffic_share_two_loads")
def _q3_two(spark, sf_dir):
    """Q3 as written over a history layer with two versions of every satellite row."""
    return dashboards.airport_traffic_share(_two_load_vault(spark, sf_dir), AS_OF)


@register("airport_traffic_share_latest")
def _q3_latest(spark, sf_dir):
    """Q3 over the same two-load history, reading only the latest satellite versions."""
    return dashboards.airport_traffic_share(_two_load_vault(spark, sf_dir), AS_OF, latest=True)


@register("passenger_metrics_30d_corrected")
def _q4c(spark, sf_dir):
    """Q4 with latest versions and ticket-flight amounts as revenue."""
    return dashboards.passenger_metrics_30d(_vault(spark, sf_dir), AS_OF, latest=True, revenue="ticket_amount")


@register("passenger_groups_revenue_corrected")
def _q5c(spark, sf_dir):
    """Q5 with latest versions and ticket-flight amounts as revenue."""
    return dashboards.passenger_groups_revenue(_vault(spark, sf_dir), AS_OF, latest=True, revenue="ticket_amount")


@register("replace_partition_flow")
def _op_replace(spark, sf_dir):
    """Passenger-flow mart table after three publishes (day 1 and day 2 as written,
    then day 2 replaced by its corrected rows), read back from storage."""
    t = _airline(spark, sf_dir)
    target = scratch_path(spark, "airport-passenger-flow")
    sinks.ensure_dataset(spark, target, MARTS["airport_passenger_flow"], partition_by=["flight_date"])
    for as_of, corrected in ((dt.date(2001, 7, 31), False), (AS_OF, False), (AS_OF, True)):
        rows = marts.build_airport_passenger_flow(t, as_of, created_at=LOAD_TS, corrected=corrected)
        sinks.replace_partitions(rows, target, ["flight_date"])
    return spark.read.parquet(target)


@register("refused_publish_keeps_flow")
def _op_refused(spark, sf_dir):
    """Passenger-flow mart table after one good publish and three refused ones (a negative
    count, a repeated key, no rows at all), read back: the good rows are untouched."""
    target = scratch_path(spark, "airport-passenger-flow")
    rows = marts.build_airport_passenger_flow(_airline(spark, sf_dir), AS_OF, created_at=LOAD_TS)
    flow_checks = [lambda d: quality.check_rules(d, marts.flow_rules()), quality.check_not_empty,
                   marts.check_mart("airport_passenger_flow")]
    sinks.replace_partitions(rows, target, ["flight_date"], checks=flow_checks)
    for bad in (rows.withColumn("flights_in", F.lit(-1)), rows.unionAll(rows), rows.where("flights_out < 0")):
        try:
            sinks.replace_partitions(bad, target, ["flight_date"], checks=flow_checks)
        except quality.DataQualityError:
            continue
        raise AssertionError("a publish that breaks the mart's rules went through")
    return spark.read.parquet(target)


@register("vault_constraint_report")
def _vault_report(spark, sf_dir):
    """Key checks of the stored history layer: unique hash keys / ids / versions,
    and link and satellite references resolving to their hubs and links."""
    return checks.vault_report(_stored_history(spark, sf_dir))
