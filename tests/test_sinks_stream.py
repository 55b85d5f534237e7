"""Publishing sinks and the streaming history load."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from skyledger.oracle import ORACLE
from skyledger.operators import sinks
from skyledger.operators.quality import DataQualityError, check_rules
from skyledger.plans import marts, vault
from skyledger.schemas import MARTS
from skyledger.sources import cdc, fixture
from skyledger.streaming import vault_stream

from tools.oracle_check import duck

from .conftest import SF_SMALL

AS_OF = dt.date(2001, 8, 1)


def test_upsert_table_versions_and_full_refresh(spark, scratch):
    sch = "k string, v int"
    sinks.upsert_table(spark.createDataFrame([("a", 1), ("b", 1)], sch), scratch, ["k"])
    sinks.upsert_table(spark.createDataFrame([("b", 2), ("c", 2)], sch), scratch, ["k"])
    assert sinks.versions(spark, scratch) == [0, 1]
    cur = sorted(tuple(r) for r in sinks.read_current(spark, scratch).collect())
    assert cur == [("a", 1), ("b", 2), ("c", 2)]          # lapsed 'a' stays (upsert, as written)
    sinks.upsert_table(spark.createDataFrame([("c", 3)], sch), scratch, ["k"], full=True)
    assert [tuple(r) for r in sinks.read_current(spark, scratch).collect()] == [("c", 3)]
    with pytest.raises(DataQualityError):
        sinks.upsert_table(spark.createDataFrame([("d", 1), ("d", 2)], sch), scratch, ["k"])
    assert sinks.versions(spark, scratch) == [0, 1, 2]


def test_failed_check_publishes_nothing(spark, scratch):
    sch = "k string, v int"
    sinks.upsert_table(spark.createDataFrame([("a", 1)], sch), scratch, ["k"])
    bad = spark.createDataFrame([("b", -1)], sch)
    with pytest.raises(DataQualityError):
        sinks.upsert_table(bad, scratch, ["k"], checks=[lambda d: check_rules(d, {"neg": F.col("v") < 0})])
    assert sinks.versions(spark, scratch) == [0]


def test_replace_partitions_keeps_other_days(spark, scratch):
    sch = "flight_date date, airport_code string, n int"
    d1, d2 = dt.date(2001, 7, 30), dt.date(2001, 7, 31)
    sinks.replace_partitions(spark.createDataFrame([(d1, "A", 1), (d2, "A", 1)], sch), scratch, ["flight_date"])
    sinks.replace_partitions(spark.createDataFrame([(d2, "B", 2)], sch), scratch, ["flight_date"])
    got = sorted((r.flight_date, r.airport_code, r.n) for r in spark.read.parquet(scratch).collect())
    assert got == [(d1, "A", 1), (d2, "B", 2)]


def test_flow_mart_refresh_end_to_end(spark, scratch):
    t = fixture.airline_tables(spark, "/root/testdata/sf0.01")
    out = marts.refresh_airport_passenger_flow(t, scratch, AS_OF)
    stored = spark.read.parquet(scratch)
    expected = duck("/root/testdata/sf0.01").execute(ORACLE["airport_passenger_flow"]).fetchall()
    assert stored.count() == out.count() == len(expected) > 0
    assert stored.where(F.col("flight_date") != F.lit(AS_OF - dt.timedelta(days=1))).count() == 0


def test_frequent_flyer_refresh_and_schema(spark, scratch):
    t = fixture.airline_tables(spark, SF_SMALL)
    marts.refresh_frequent_flyers(t, scratch, AS_OF)
    cur = sinks.read_current(spark, scratch)
    assert [f.name for f in cur.schema.fields] == [f.name for f in MARTS["frequent_flyers"].fields]
    assert cur.groupBy("passenger_id").count().where("count > 1").count() == 0


def test_vault_load_idempotent_and_incremental(spark, scratch):
    t = fixture.airline_tables(spark, SF_SMALL)
    vault.load_vault(spark, t, scratch, 0, "2001-08-01 00:00:00")
    first = {n: df.count() for n, df in vault.read_vault(spark, scratch).items()}
    vault.load_vault(spark, t, scratch, 0, "2001-08-01 00:00:00")          # replay of batch 0
    assert {n: df.count() for n, df in vault.read_vault(spark, scratch).items()} == first
    vault.load_vault(spark, t, scratch, 1, "2001-08-02 00:00:00", on_unchanged="skip")
    again = {n: df.count() for n, df in vault.read_vault(spark, scratch).items()}
    assert again == first                                                    # nothing changed, nothing added
    vault.load_vault(spark, t, scratch, 2, "2001-08-03 00:00:00")            # as written: new versions
    third = {n: df.count() for n, df in vault.read_vault(spark, scratch).items()}
    for n in vault.TABLES:
        assert third[n] == (2 * first[n] if n.startswith("sat_") else first[n])


def _write_feed(path, rows):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, f"part-{len(os.listdir(path))}.json"), "w") as fh:
        for r in rows:
            fh.write(json.dumps(r) + "\n")


def test_stream_loads_vault_and_resumes(spark, scratch):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    feed = fixture.change_feed(events).orderBy("offset", "topic").collect()
    rows = [{"topic": r.topic, "partition": r.partition, "offset": r.offset,
             "timestamp": r.timestamp.isoformat(), "key": r.key, "value": r.value} for r in feed]
    half = len(rows) // 2
    src, root, ckpt, quar = (f"{scratch}/feed", f"{scratch}/vault", f"{scratch}/ckpt", f"{scratch}/quarantine")
    src_local = src.replace("file:", "")
    _write_feed(src_local, rows[:half] + [
        {"topic": "airline.public.airports", "partition": 0, "offset": 10 ** 9, "timestamp": None,
         "key": None, "value": "{broken"},
        {"topic": "airline.public.airports", "partition": 0, "offset": 10 ** 9 + 1, "timestamp": None,
         "key": None, "value": None}])
    stream = cdc.cdc_source(spark, kind="json", path=src, options={"maxFilesPerTrigger": "1"})
    q = vault_stream.start_vault_stream(stream, root, ckpt, quarantine_path=quar)
    q.awaitTermination()
    _write_feed(src_local, rows[half:] + rows[:10])                     # second file: rest + redelivered head
    q = vault_stream.start_vault_stream(stream, root, ckpt, quarantine_path=quar)
    q.awaitTermination()
    v = vault.read_vault(spark, root)
    static = vault_stream.batch_load_from_feed(spark, fixture.change_feed(events))
    for name in ("hub_airports", "hub_aircrafts", "sat_airport_details", "sat_aircraft_details"):
        got = v[name].select(*static[name].columns)
        assert got.exceptAll(static[name]).count() == 0 and static[name].exceptAll(got).count() == 0, name
    assert spark.read.parquet(quar).select("reject_reason").collect()[0].reject_reason == "malformed"
    assert sorted(r.batch_id for r in spark.read.parquet(f"{root}/hub_airports").select("batch_id")
                  .distinct().collect()) == [0]


def test_stream_of_all_tables_equals_batch_history(spark, scratch):
    """Every booking-model table as a change stream (tickets in one batch, their
    legs and boarding passes in the next) gives the same history layer as the
    batch load (load times aside)."""
    from skyledger.schemas import PRIMARY_KEYS
    t = fixture.airline_tables(spark, SF_SMALL)
    tables = ["airports", "aircrafts", "flights", "bookings", "tickets", "ticket_flights", "boarding_passes"]
    feeds = {}
    for name in tables:
        empty = spark.createDataFrame([], t[name].schema)
        feeds[name] = cdc.to_envelopes(cdc.snapshot_diff(empty, t[name], PRIMARY_KEYS[name]), name).collect()
    src = f"{scratch}/feed".replace("file:", "")
    for group in (tables[:5], tables[5:]):
        rows = [{"topic": r.topic, "partition": r.partition, "offset": r.offset,
                 "timestamp": r.timestamp.isoformat(), "key": r.key, "value": r.value}
                for n in group for r in feeds[n]]
        _write_feed(src, rows)
    stream = cdc.cdc_source(spark, kind="json", path=src, options={"maxFilesPerTrigger": "1"})
    q = vault_stream.start_vault_stream(stream, f"{scratch}/vault", f"{scratch}/ckpt", tables=tables)
    q.awaitTermination()
    streamed = vault.read_vault(spark, f"{scratch}/vault")
    batch = vault.build_vault(t, "2001-08-01 00:00:00")
    assert set(streamed) == set(vault.TABLES)
    for name in vault.TABLES:
        cols = [c for c in batch[name].columns if c != "load_date"]
        a = sorted(tuple(r) for r in streamed[name].select(*cols).distinct().collect())
        b = sorted(tuple(r) for r in batch[name].select(*cols).distinct().collect())
        assert a == b, name


def test_ensure_dataset_creates_once(spark, scratch):
    sinks.ensure_dataset(spark, scratch, MARTS["airport_passenger_flow"], partition_by=["flight_date"])
    assert spark.read.schema(MARTS["airport_passenger_flow"]).parquet(scratch).count() == 0
    sinks.ensure_dataset(spark, scratch, MARTS["airport_passenger_flow"])      # exists: no-op
    v = f"{scratch}-v"
    sinks.ensure_dataset(spark, v, MARTS["frequent_flyers"], versioned=True)
    assert sinks.versions(spark, v) == [0]


def test_stream_snapshot_reads_and_unchanged_skip(spark, scratch):
    feed_rows = [
        {"topic": "airline.public.airports", "partition": 0, "offset": i, "timestamp": f"2024-01-01T00:00:0{i}",
         "key": "AAA", "value": json.dumps({"payload": {"op": op, "after": {
             "airport_code": "AAA", "airport_name": name, "city": "C", "coordinates_lon": 1.0,
             "coordinates_lat": 2.0, "timezone": "UTC"}}})}
        for i, (op, name) in enumerate([("r", "Snap"), ("u", "Snap"), ("u", "Snap"), ("u", "New")])]
    src = f"{scratch}/feed".replace("file:", "")
    _write_feed(src, feed_rows)
    stream = cdc.cdc_source(spark, kind="json", path=src)
    q = vault_stream.start_vault_stream(stream, f"{scratch}/vault", f"{scratch}/ckpt", tables=["airports"],
                                        include_snapshot=True, on_unchanged="skip")
    q.awaitTermination()
    sat = vault.read_vault(spark, f"{scratch}/vault")["sat_airport_details"]
    assert sorted(r.airport_name for r in sat.collect()) == ["New", "Snap"]   # unchanged updates skipped


def test_skip_unchanged_compares_with_true_predecessor(spark):
    sat = next(s for s in vault.SATELLITES if s.name == "sat_aircraft_details")
    sch = "aircraft_hub_id long, load_date timestamp, model string, range int, hash_diff string"
    T0 = dt.datetime(2024, 1, 1)
    stored = spark.createDataFrame([(1, T0, "m", 1, "h1")], sch)
    rows = spark.createDataFrame([(1, T0 + dt.timedelta(hours=h), "m", 1, hd)
                                  for h, hd in ((1, "h1"), (2, "h2"), (3, "h2"), (4, "h1"))]
                                 + [(2, T0, "m", 1, "x")], sch)
    got = sorted((r.aircraft_hub_id, r.hash_diff, r.load_date.hour)
                 for r in vault.new_satellite_rows(sat, rows, stored, "skip").collect())
    assert got == [(1, "h1", 4), (1, "h2", 2), (2, "x", 0)]
    assert vault.new_satellite_rows(sat, rows, stored, "append").count() == 5


def _message(table, offset, op, image, second=0):
    return {"topic": f"airline.public.{table}", "partition": 0, "offset": offset, "timestamp": f"2024-01-01T00:00:{second:02d}",
            "key": None, "value": json.dumps({"payload": {"op": op, "after": image}})}


@pytest.mark.parametrize("order", [("ticket", "leg", "pass"), ("leg", "ticket", "pass"), ("pass", "leg", "ticket"), ("ticket", "pass", "leg")])
def test_legs_wait_for_their_ticket(spark, scratch, order):
    """Topics have no mutual order: in whichever batches ticket, leg and pass
    arrive, the leg ends up linked with its boarding data."""
    images = {"ticket": ("tickets", {"ticket_no": "0000000000001", "book_ref": "00000A", "passenger_id": "p1", "passenger_name": "N", "contact_data": "{}"}),
              "leg": ("ticket_flights", {"ticket_no": "0000000000001", "flight_id": 7, "fare_conditions": "1.00", "amount": "9.50"}),
              "pass": ("boarding_passes", {"ticket_no": "0000000000001", "flight_id": 7, "boarding_no": 3, "seat_no": "2A"})}
    src = f"{scratch}/feed".replace("file:", "")
    for i, what in enumerate(order):
        table, image = images[what]
        booking = {"book_ref": "00000A", "book_date": "2024-01-01T00:00:00", "total_amount": "9.50"}
        _write_feed(src, [_message(table, i, "c", image, i)] + ([_message("bookings", 0, "c", booking)] if i == 0 else []))
        feed = cdc.cdc_source(spark, kind="json", path=src, options={"maxFilesPerTrigger": "1"})
        vault_stream.start_vault_stream(feed, f"{scratch}/vault", f"{scratch}/ckpt",
                                        tables=["bookings", "tickets", "ticket_flights", "boarding_passes"]).awaitTermination()
    v = vault.read_vault(spark, f"{scratch}/vault")
    assert v["link_ticket_flight"].count() == 1
    last = v["sat_ticket_flight_details"].orderBy(F.desc("load_date")).collect()
    assert any((r.boarding_no, r.seat_no, float(r.amount)) == (3, "2A", 9.5) for r in last)
    assert all(r.ticket_flight_link_id is not None for r in last)


def test_bad_images_go_to_quarantine(spark, scratch):
    good = {"airport_code": "AAA", "airport_name": "N", "city": "C", "coordinates_lon": 1.0, "coordinates_lat": 2.0, "timezone": "UTC"}
    rows = [_message("airports", 0, "c", good), _message("airports", 1, "c", {}), _message("airports", 2, "c", {**good, "airport_code": None}),
            _message("airports", 3, "c", 5), _message("airports", 4, "c", {**good, "coordinates_lon": "west"}), _message("airports", 5, "c", {"city": "C"})]
    src = f"{scratch}/feed".replace("file:", "")
    _write_feed(src, rows)
    feed = cdc.cdc_source(spark, kind="json", path=src)
    vault_stream.start_vault_stream(feed, f"{scratch}/vault", f"{scratch}/ckpt", tables=["airports"], quarantine_path=f"{scratch}/q").awaitTermination()
    v = vault.read_vault(spark, f"{scratch}/vault")
    assert v["sat_airport_details"].count() == v["hub_airports"].count() == 1
    assert v["sat_airport_details"].where("airport_hub_id is null").count() == 0
    got = {r["offset"]: r.reject_reason for r in spark.read.parquet(f"{scratch}/q").collect()}
    assert set(got) == {2, 3, 4, 5} and got[2] == got[5] == "missing_value" and got[3] == got[4] == "bad_image"


def test_writers_keep_their_own_batches(spark, scratch):
    """A backfill numbered 42 and a stream from 0, then the same stream on a new checkpoint:
    no key is stored twice and nothing stored is overwritten."""
    airport = {"airport_code": "AAA", "airport_name": "N", "city": "C", "coordinates_lon": 1.0, "coordinates_lat": 2.0, "timezone": "UTC"}
    t = {"airports": spark.createDataFrame([tuple(airport.values())], "airport_code string, airport_name string, city string, "
                                           "coordinates_lon double, coordinates_lat double, timezone string")}
    root, src = f"{scratch}/vault", f"{scratch}/feed".replace("file:", "")
    vault.load_vault(spark, t, root, 42, "2023-01-01 00:00:00", tables=["hub_airports", "sat_airport_details"])
    _write_feed(src, [_message("airports", 0, "u", {**airport, "city": "D"}), _message("airports", 1, "c", {**airport, "airport_code": "BBB"})])

    def stream(checkpoint):
        feed = cdc.cdc_source(spark, kind="json", path=src, options={"maxFilesPerTrigger": "1"})
        vault_stream.start_vault_stream(feed, root, f"{scratch}/{checkpoint}", tables=["airports"]).awaitTermination()
        v = vault.read_vault(spark, root)
        return (sorted(r.airport_code for r in v["hub_airports"].collect()), v["sat_airport_details"].count())
    assert stream("one") == (["AAA", "BBB"], 3)
    _write_feed(src, [_message("airports", 2, "u", {**airport, "city": "E"}, 5)])
    assert stream("one") == (["AAA", "BBB"], 4)
    assert stream("two") == (["AAA", "BBB"], 4)              # all redelivered under new batch ids
    writers = {r.writer for r in spark.read.parquet(f"{root}/hub_airports").select("writer").distinct().collect()}
    assert "batch" in writers and "stream" not in writers and len(writers) == 2      # the stream writes under its query id


def test_equal_message_times_follow_the_topic(spark):
    """Two tickets images of one time: the one with the higher offset holds."""
    src = {"tickets": spark.createDataFrame([("t1", "B2", "p2", dt.datetime(2024, 1, 1), 0, 9), ("t1", "B1", "p1", dt.datetime(2024, 1, 1), 0, 10)],
                                            "ticket_no string, book_ref string, passenger_id string, _load_ts timestamp, _partition int, _offset long")}
    assert [tuple(r) for r in vault_stream.ticket_keys(src, {}).collect()] == [("t1", "B1", "p1")]


def test_upsert_goes_on_after_a_failed_attempt(spark, scratch):
    rows = spark.createDataFrame([(1, "a")], "k int, x string")
    sinks.upsert_table(rows, scratch, ["k"])
    os.makedirs(f"{scratch.replace('file:', '')}/v=1")            # a writer died before its commit
    sinks.upsert_table(spark.createDataFrame([(2, "b")], "k int, x string"), scratch, ["k"])
    assert sorted(r.k for r in sinks.read_current(spark, scratch).collect()) == [1, 2]
