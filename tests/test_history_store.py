"""Batches that appear at once, buckets, compaction, waiting rows."""

import os

import pytest
from pyspark.sql import functions as F

from skyledger.operators import commits
from skyledger.plans import vault
from skyledger.sources import cdc, fixture
from skyledger.streaming import vault_stream

from .conftest import SF_SMALL

LOAD = "2001-08-01 00:00:00"
KEYS = {"a": "k", "b": "k"}


def fill(spark, root, batches, rows=40, buckets=16):
    for n in batches:
        b = commits.Batch(spark, root, "w", n, KEYS, buckets)
        b.write("a", spark.range(n * rows, (n + 1) * rows).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v")))
        b.write("b", spark.range(n).select(F.col("id").alias("k")))
        b.commit()


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_a_small_batch_lists_and_reads_only_its_buckets(spark, scratch):
    fill(spark, scratch, range(3), rows=400, buckets=32)
    batch = commits.Batch(spark, scratch, "w", 3, KEYS)
    ten = spark.range(5, 15).select(F.col("id").alias("k"))
    wanted = {r["b"] for r in ten.select(commits.bucket_of("k", 32).alias("b")).collect()}
    near = batch.near("a", ten)
    read = {int(f.split("bucket=")[1].split("/")[0]) for f in near.inputFiles()}
    every = commits.read_table(spark, scratch, "a")
    assert read == wanted and len(near.inputFiles()) < len(every.inputFiles()) / 2
    assert rows_of(near.join(ten, "k")) == rows_of(every.join(ten, "k")) and near.join(ten, "k").count() == 10
    assert batch.near("a", ten.limit(0)).count() == 0 and batch.near("c", ten) is None


def test_compaction_keeps_every_row_and_repeats_stay_possible(spark, scratch):
    fill(spark, scratch, range(9))
    before = rows_of(commits.read_table(spark, scratch, "a"))
    m = commits.compact(spark, scratch, KEYS, fan=4)
    assert sorted((r.level, r.batch_id) for r in m.runs) == [(0, 8), (1, -1)]
    assert rows_of(commits.read_table(spark, scratch, "a")) == before
    files = len(commits.read_table(spark, scratch, "a").inputFiles())
    assert commits.vacuum(spark, scratch) == 2 * 8 and len(commits.read_table(spark, scratch, "a").inputFiles()) == files
    fill(spark, scratch, [8])                                    # the newest batch again: in place of itself
    assert rows_of(commits.read_table(spark, scratch, "a")) == before
    with pytest.raises(ValueError):
        commits.Batch(spark, scratch, "w", 5, KEYS)              # part of the merged run
    fill(spark, scratch, range(9, 14))
    m = commits.compact(spark, scratch, KEYS, fan=4)             # only the small runs are merged
    assert sorted(r.level for r in m.runs) == [0, 1, 1] and commits.compact(spark, scratch, KEYS, fan=4) == m
    assert commits.read_table(spark, scratch, "a").count() == 14 * 40


def test_rows_are_sorted_inside_a_merged_bucket(spark, scratch):
    fill(spark, scratch, range(5), buckets=2)
    commits.compact(spark, scratch, KEYS, fan=2, order={"a": ["v", "k"]})
    m = commits.read_manifest(spark, scratch)
    merged = commits.read_runs(spark, scratch, commits.replace(m, runs=m.runs[:1]), "a")
    for f in merged.inputFiles():
        got = [(r.v, r.k) for r in spark.read.parquet(f).collect()]
        assert got == sorted(got) and got


def test_of_two_loads_at_once_one_fails(spark, scratch):
    fill(spark, scratch, [0])
    one, two = (commits.Batch(spark, scratch, w, 0, KEYS) for w in ("x", "y"))
    for b in (one, two):
        b.write("a", spark.range(3).select(F.col("id").alias("k"), F.col("id").alias("v")))
    one.commit()
    with pytest.raises(commits.ConcurrentLoad):
        two.commit()
    assert {r.writer for r in commits.read_table(spark, scratch, "a").collect()} == {"w", "x"}


def test_other_columns_are_refused(spark, scratch):
    fill(spark, scratch, [0])
    with pytest.raises(ValueError):
        commits.Batch(spark, scratch, "w", 1, KEYS).write("a", spark.range(3).select(F.col("id").alias("k")))


def test_a_load_that_stops_shows_nothing(spark, scratch):
    t = fixture.airline_tables(spark, SF_SMALL)
    vault.write_batch(vault.begin_batch(spark, scratch, "batch", 0, 4), t, LOAD, tables=vault.TABLES[:7])   # died here
    assert len(vault.read_vault(spark, scratch)) == 0
    vault.load_vault(spark, t, scratch, 0, LOAD, buckets=4)
    full = {n: df.count() for n, df in vault.read_vault(spark, scratch).items()}
    assert set(full) == set(vault.TABLES) and full == {n: df.count() for n, df in vault.build_vault(t, LOAD).items()}
    stopped = vault.begin_batch(spark, scratch, "batch", 1)
    vault.write_batch(stopped, t, "2001-08-02 00:00:00", tables=vault.TABLES[:9])
    assert {n: df.count() for n, df in vault.read_vault(spark, scratch).items()} == full


def leg(i):
    return {"ticket_no": f"{i:013d}", "flight_id": 7, "fare_conditions": "1.00", "amount": "9.50"}


def feed(spark, rows):
    import json
    return spark.createDataFrame([(f"airline.public.{t}", 0, n, f"2024-01-01 00:00:{n % 60:02d}", None, json.dumps({"payload": {"op": "c", "after": x}}))
                                  for t, n, x in rows], "topic string, partition int, offset long, timestamp string, key string, value string"
                                 ).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def test_what_a_batch_writes_does_not_grow_with_what_waits(spark, scratch):
    """1,000 legs without a ticket; then batches of one ticket each write as many rows as with 10 waiting."""
    tables = ["bookings", "tickets", "ticket_flights", "boarding_passes"]
    written = {}
    for waiting in (10, 1000):
        root = f"{scratch}-{waiting}"
        vault_stream.load_changes_batch(feed(spark, [("ticket_flights", i, leg(i)) for i in range(waiting)]), 0, root, tables, writer="s")
        assert vault_stream.waiting_rows(spark, root).count() == waiting
        for n in (1, 2):
            rows = [("bookings", n, {"book_ref": f"B{n}", "book_date": "2024-01-01T00:00:00", "total_amount": "9.50"}),
                    ("tickets", n, {"ticket_no": f"{n:013d}", "book_ref": f"B{n}", "passenger_id": f"p{n}", "passenger_name": "N", "contact_data": "{}"})]
            vault_stream.load_changes_batch(feed(spark, rows), n, root, tables, writer="s")
        m = commits.read_manifest(spark, root)
        written[waiting] = {t: commits.read_runs(spark, root, commits.replace(m, runs=m.runs[1:]), t).where("batch_id > 0").count()
                            for t in sorted({t for r in m.runs[1:] for t in r.tables})}
        assert vault_stream.waiting_rows(spark, root).count() == waiting - 2
        assert vault.read_vault(spark, root)["link_ticket_flight"].count() == 2
        assert vault_stream.waiting_rows(spark, root, before="2024-01-01 00:00:05").count() == sum(1 for i in range(waiting) if i % 60 < 5) - 2
        vault.compact_vault(spark, root, fan=2)
        assert vault_stream.waiting_rows(spark, root).count() == waiting - 2
        assert commits.read_table(spark, root, "settled_ticket_flights").count() < 2     # settled rows went with those they settle
    assert written[10] == written[1000] and written[10]["settled_ticket_flights"] == 2


def test_redelivered_messages_are_kept_once(spark):
    rows = [("airline.public.airports", 0, i % 5, "2024-01-01 00:00:00", None, "{}") for i in range(12)]
    rows += [("airline.public.airports", 1, 0, None, None, "{}"), ("airline.public.airports", None, None, None, None, "x")]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long, timestamp string, key string, value string")
    got = cdc.drop_redelivered(df).collect()
    assert sorted((r.partition is None, r.partition or 0, r["offset"] or 0) for r in got) == [(False, 0, i) for i in range(5)] + [(False, 1, 0), (True, 0, 0)]


def test_messages_are_not_sorted_or_parsed_more_than_once(spark, scratch):
    feed(spark, [("airports", i, {"airport_code": "AAA"}) for i in range(5)]).write.parquet(f"{scratch}/f")
    plan = cdc.parse_changes(spark.read.parquet(f"{scratch}/f"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1                     # one generator parses; filters use its result
    physical = cdc.drop_redelivered(spark.read.parquet(f"{scratch}/f"))._jdf.queryExecution().executedPlan().toString()
    once = physical.split("SortAggregate")[0]               # the branch of all messages that came once
    assert "Sort" not in once.replace("SortMerge", "")


def test_newest_version_needs_no_sort_aggregate(spark):
    import datetime as dt
    import hashlib
    rows = [(p, dt.datetime(2024, 1, 1 + v), hashlib.md5(f"{p}{v}{k}".encode()).hexdigest(), f"{v}{k}") for p in range(30) for v in range(p % 4 + 1) for k in "ab"]
    df = spark.createDataFrame(rows, "p long, load_date timestamp, hash_diff string, payload string")
    from skyledger.operators.ranking import latest_version, newest_version
    got = newest_version(df, "p")
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()
    want = latest_version(df, "p", ["load_date", "hash_diff"])
    assert rows_of(got) == rows_of(want) and got.count() == 30


def test_digests_find_the_rows_that_differ(spark):
    from skyledger.operators import quality
    sch = "k int, v string, w double"
    a = spark.createDataFrame([(i % 40, None if i % 3 else str(i), i / 4) for i in range(200)] + [(None, None, None), (1, "x", None)], sch)
    b = a.where("k is null or k <> 7").unionByName(spark.createDataFrame([(1, None, 1.0), (None, "x", None), (None, None, None), (99, "n", 0.0)], sch))
    for x, y in ((a, b), (b, a), (a, a), (a, a.limit(0)), (a.limit(0), a.limit(0)), (a, a.unionByName(a.limit(1)))):
        assert sorted(map(repr, quality.table_diff_by_digest(x, y, ["k"], 16).collect())) == sorted(map(repr, quality.table_diff(x, y).collect()))
    assert quality.differing_buckets(*(quality.bucket_digests(x, ["k"], 16) for x in (a, a.repartition(3)))).count() == 0
    # a value moved between NULL and not NULL columns, or between rows, is seen
    p, q = spark.createDataFrame([("a", None), (None, "b")], "x string, y string"), spark.createDataFrame([(None, "a"), ("b", None)], "x string, y string")
    assert quality.differing_buckets(*(quality.bucket_digests(x.withColumn("k", F.lit(1)), ["k"], 4) for x in (p, q))).count() == 1


def test_a_first_load_shuffles_business_columns_and_not_digests(spark, scratch):
    t = fixture.airline_tables(spark, SF_SMALL)
    batch = vault.begin_batch(spark, scratch, "batch", 0, 4)
    made = vault.build_vault(t, LOAD, ["link_ticket_flight", "sat_ticket_flight_details"], lambda name: batch.spread)
    for name, digests in (("link_ticket_flight", "ticket_flight_hash_key"), ("sat_ticket_flight_details", "hash_diff")):
        lines = made[name]._jdf.queryExecution().optimizedPlan().toString().split("\n")
        at = next(i for i, x in enumerate(lines) if "RebalancePartitions" in x)
        assert digests in lines[0] and not any(digests in x for x in lines[at:]), name


def test_messages_that_come_once_are_neither_joined_nor_shuffled(spark, scratch):
    feed(spark, [("ticket_flights", i, leg(i)) for i in range(3)]).write.parquet(f"{scratch}/f")
    plan = cdc.parse_changes(spark.read.parquet(f"{scratch}/f"), once=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_a_leg_meets_its_pass_without_another_shuffle(spark):
    legs = vault.sources(fixture.airline_tables(spark, SF_SMALL))["ticket_legs"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = legs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # two groupings of lines, orders and customers, tickets and legs by ticket
    assert plan.count("Exchange hashpartitioning") == 6


def test_legs_are_stored_without_a_shuffle_of_their_own(spark, scratch):
    legs = vault.sources(fixture.airline_tables(spark, SF_SMALL))["ticket_legs"]
    batch = vault.begin_batch(spark, scratch, "batch", 0, 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        link = vault.build_vault({"ticket_legs": legs}, LOAD, ["link_ticket_flight"], lambda name: batch.aligned)["link_ticket_flight"]
        plans = [x._jdf.queryExecution().executedPlan().toString() for x in (batch.aligned(legs, F.col("ticket_no")), link)]
        found = link.select("bucket").distinct().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the six that make the legs
    assert [p.count("Exchange") for p in plans] == [6, 6]
    assert {r.bucket for r in found} == {0, 1, 2, 3}


def test_a_batch_leaves_no_staged_files(spark, scratch):
    from skyledger.session import checkpoint_dir
    vault_stream.load_changes_batch(feed(spark, [("ticket_flights", 1, leg(1))]), 0, scratch, ["ticket_flights"])
    assert not [n for n in os.listdir(checkpoint_dir(spark)) if n.startswith("feed-") and os.listdir(f"{checkpoint_dir(spark)}/{n}")]


def test_a_table_of_one_merged_run_is_taken_over(spark, scratch):
    for n, table in enumerate("abab"):
        x = commits.Batch(spark, scratch, "w", n, KEYS, 4)
        x.write(table, spark.range(n * 40, n * 40 + 40).select((F.col("id") * 37 % 101).alias("k"), F.col("id").alias("v")))
        x.commit()
    commits.compact(spark, scratch, KEYS, fan=2)                    # of batches 0 to 2 only one holds b
    m = commits.read_manifest(spark, scratch)
    written = {t: commits.read_runs(spark, scratch, commits.replace(m, runs=m.runs[:1]), t).inputFiles() for t in "ab"}
    assert all(m.runs[0].run in f for f in written["a"]) and not any(m.runs[0].run in f for f in written["b"])
    for f in written["a"] + written["b"]:
        got = [r.k for r in spark.read.parquet(f).collect()]
        assert got == sorted(got) and got
    assert commits.vacuum(spark, scratch) == 2                      # a's two runs; b's files are named by the manifest
    assert sorted(r.v for t in "ab" for r in commits.read_table(spark, scratch, t).collect()) == list(range(160))


def test_digests_are_stored_once_and_shown_whole(spark, scratch):
    t = fixture.airline_tables(spark, SF_SMALL)
    vault.load_vault(spark, t, scratch, 0, LOAD, buckets=4)
    made, stored = vault.build_vault(t, LOAD), vault.read_vault(spark, scratch)
    for name in ("hub_bookings", "link_ticket_flight", "sat_ticket_flight_details"):
        assert stored[name].columns == made[name].columns and sorted(map(repr, stored[name].collect())) == sorted(map(repr, made[name].collect()))
        raw = {f.name: f.dataType.simpleString() for f in commits.read_table(spark, scratch, name).schema}
        assert not any(c.endswith("_hash_key") for c in raw) and raw.get("hash_diff", "binary") == "binary"
    legs = commits.read_runs(spark, scratch, commits.read_manifest(spark, scratch), "link_ticket_flight")
    assert legs.groupBy("ticket_booking_link_id").agg(F.count_distinct("bucket").alias("n")).where("n > 1").isEmpty()


def test_repeated_places_are_seen_without_a_row_per_message(spark):
    feed = spark.range(-300, 5000).select(F.lit("t").alias("topic"), (F.col("id") % 3).cast("int").alias("partition"), F.col("id").alias("offset"))
    none = spark.createDataFrame([("t", None, 1), ("t", None, 1), (None, 0, 1), (None, 0, 1)], "topic string, partition int, offset long")
    assert not cdc.has_redelivered(feed.unionByName(none)) and not cdc.has_redelivered(feed.limit(0))
    for again in (-300, -1, 0, 63, 64, 4999):
        assert cdc.has_redelivered(feed.unionByName(feed.where(F.col("offset") == again)))


def test_waiting_legs_meet_passes_and_tickets_by_ticket(spark, scratch):
    """Two legs of a ticket, one with a pass in two versions, and a pass without its leg."""
    tables = ["bookings", "tickets", "ticket_flights", "boarding_passes"]
    legs = [("ticket_flights", i, {**leg(1), "flight_id": 7 + i}) for i in range(2)]
    passes = [("boarding_passes", n, {"ticket_no": f"{1:013d}", "flight_id": f, "boarding_no": n, "seat_no": f"{n}A"}) for n, f in ((3, 8), (4, 8), (5, 99))]
    vault_stream.load_changes_batch(feed(spark, legs + passes), 0, scratch, tables, writer="s")
    rows = [("bookings", 1, {"book_ref": "B", "book_date": "2024-01-01T00:00:00", "total_amount": "9.50"}),
            ("tickets", 1, {"ticket_no": f"{1:013d}", "book_ref": "B", "passenger_id": "p", "passenger_name": "N", "contact_data": "{}"})]
    vault_stream.load_changes_batch(feed(spark, rows), 1, scratch, tables, writer="s")
    got = vault.read_vault(spark, scratch)["sat_ticket_flight_details"].select("boarding_no", "seat_no").collect()
    assert sorted(map(tuple, got), key=str) == [(4, "4A"), (None, None)]
    assert [r.flight_id for r in vault_stream.waiting_rows(spark, scratch).collect()] == [99]
