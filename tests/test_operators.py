"""Hand-built cases for the semantic traps and properties of the operators."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import Window
from pyspark.sql import functions as F

from skyledger.functions.keys import hash_columns, surrogate_id
from skyledger.functions.numeric import percent_half_up, round_half_up_ratio
from skyledger.operators.joins import either_endpoint_join, swap_roles
from skyledger.operators.ranking import (bucket_by_thresholds, latest_version, modal_value, percent_rank,
                                         share_of_total, tier_by_percent_rank)
from skyledger.plans import marts, traffic
from skyledger.schemas import OLTP
from skyledger.sources import cdc

TS = dt.datetime(2001, 7, 31, 10, 0)


def flights_df(spark, rows):
    """rows: (flight_id, dep, arr, status, sched, actual_dep)"""
    full = [(fid, f"F{fid:05d}", s, s + dt.timedelta(hours=2), dep, arr, st, "B01", a, None)
            for fid, dep, arr, st, s, a in rows]
    return spark.createDataFrame(full, OLTP["flights"])


def tickets_df(spark, rows):
    """rows: (ticket_no, passenger_id, name)"""
    return spark.createDataFrame([(t, "000001", p, n, None) for t, p, n in rows], OLTP["tickets"])


def tf_df(spark, rows):
    """rows: (ticket_no, flight_id, amount)"""
    return spark.createDataFrame([(t, f, Decimal("0.05"), Decimal(str(a))) for t, f, a in rows],
                                 OLTP["ticket_flights"])


# --- airport_traffic ---------------------------------------------------------------------
def test_airport_traffic_edge_cases(spark):
    f = flights_df(spark, [
        (1, "AAA", "BBB", "Arrived", TS, TS),   # AAA only departs, BBB only arrives
        (2, None, "BBB", "Arrived", TS, TS),    # NULL departure
        (3, "AAA", None, "Arrived", TS, TS),    # NULL arrival, no tickets
    ])
    t = tickets_df(spark, [("T1", "P1", "Ann"), ("T2", "P2", "Bob")])
    tf = tf_df(spark, [("T1", 1, 10), ("T2", 1, 20), ("T9", 1, 5), ("T1", 2, 7)])  # T9: no ticket row
    out = {(r.airport_code, r.departure_flights_num, r.arrival_flights_num): r for r in
           traffic.airport_traffic({"flights": f, "tickets": t, "ticket_flights": tf}).collect()}
    rows = sorted((r.airport_code or "~", r.departure_flights_num, r.departure_psngr_num,
                   r.arrival_flights_num, r.arrival_psngr_num) for r in out.values())
    assert rows == [
        ("AAA", 2, 2, 0, 0),      # flights 1 and 3; 2 matched tickets (T9 not counted)
        ("BBB", 0, 0, 2, 3),      # arrivals 1 and 2
        ("~", 0, 0, 1, 0),        # NULL arrival side of flight 3
        ("~", 1, 1, 0, 0),        # NULL departure side of flight 2: its own row
    ]


# --- passenger flow mart ---------------------------------------------------------------------
def test_flow_mart_as_written_and_corrected(spark):
    f = flights_df(spark, [
        (1, "AAA", "BBB", "Arrived", TS, TS),         # 3 tickets
        (2, "AAA", "BBB", "Departed", TS, None),      # no tickets
        (3, "CCC", "AAA", "Arrived", TS, TS),         # inbound only for AAA<-CCC
        (4, "BBB", "AAA", "Scheduled", TS, None),     # not flown
    ])
    tf = tf_df(spark, [("T1", 1, 1), ("T2", 1, 1), ("T3", 1, 1), ("T4", 3, 1)])
    t = {"flights": f, "ticket_flights": tf}
    asof = dt.date(2001, 8, 1)
    aw = {(r.airport_code, r.linked_airport_code): r for r in marts.build_airport_passenger_flow(t, asof).collect()}
    assert set(aw) == {("AAA", "BBB"), ("CCC", "AAA")}
    assert (aw["AAA", "BBB"].flights_out, aw["AAA", "BBB"].passengers_out) == (4, 3)   # 3 ticket rows + empty flight
    assert (aw["AAA", "BBB"].flights_in, aw["AAA", "BBB"].passengers_in) == (0, 0)
    co = {(r.airport_code, r.linked_airport_code): r
          for r in marts.build_airport_passenger_flow(t, asof, corrected=True).collect()}
    assert set(co) == {("AAA", "BBB"), ("BBB", "AAA"), ("CCC", "AAA"), ("AAA", "CCC")}
    assert co["AAA", "BBB"].flights_out == 2
    assert (co["AAA", "CCC"].flights_in, co["AAA", "CCC"].passengers_in, co["AAA", "CCC"].flights_out) == (1, 1, 0)
    assert all(r.flight_date == dt.date(2001, 7, 31) for r in co.values())


def test_flow_mart_empty_day_is_refused(spark, scratch):
    from skyledger.operators.quality import DataQualityError
    f = flights_df(spark, [(1, "AAA", "BBB", "Arrived", TS - dt.timedelta(days=3), None)])
    t = {"flights": f, "ticket_flights": tf_df(spark, [])}
    with pytest.raises(DataQualityError, match="No data"):
        marts.refresh_airport_passenger_flow(t, scratch, dt.date(2001, 8, 1))


# --- frequent flyers --------------------------------------------------------------------------
def test_home_airport_ties_and_single_name(spark):
    f = flights_df(spark, [
        (1, "AAA", "BBB", "Arrived", TS - dt.timedelta(days=2), None),
        (2, "BBB", "AAA", "Arrived", TS - dt.timedelta(days=1), None),   # same count, later -> BBB
        (3, "DDD", "AAA", "Arrived", TS, None),
        (4, "CCC", "AAA", "Arrived", TS, None),                          # same count and time -> CCC
    ])
    t = tickets_df(spark, [("T1", "P1", "Ann Old"), ("T2", "P1", "Ann New"), ("T3", "P2", "Bob")])
    tf = tf_df(spark, [("T1", 1, 10), ("T2", 2, 20), ("T3", 3, 5), ("T3", 4, 5)])
    out = {r.passenger_id: r for r in
           marts.build_frequent_flyers({"flights": f, "tickets": t, "ticket_flights": tf}, dt.date(2001, 8, 1))
           .collect()}
    assert out["P1"].home_airport == "BBB" and out["P1"].passenger_name == "Ann New"
    assert out["P1"].flights_number == 2 and out["P1"].purchase_sum == Decimal("30.00")
    assert out["P2"].home_airport == "CCC"
    assert out["P1"].customer_group == "5" and out["P2"].customer_group == "50+"


def test_modal_value_null_order(spark):
    df = spark.createDataFrame([("k", None, TS), ("k", "ZZZ", TS)], "k string, v string, ts timestamp")
    assert modal_value(df, ["k"], "v", "ts").first().v == "ZZZ"   # ASC NULLS LAST
    df2 = spark.createDataFrame([("k", "AAA", None), ("k", "BBB", TS)], "k string, v string, ts timestamp")
    assert modal_value(df2, ["k"], "v", "ts").first().v == "AAA"  # max(ts) DESC NULLS FIRST


# --- percent rank ----------------------------------------------------------------------------------
def _reference_pr(spark, df, col):
    w = Window.orderBy(F.col(col).desc_nulls_first())
    return {r[0]: r[1] for r in df.select("id", F.percent_rank().over(w)).collect()}


@pytest.mark.parametrize("seed,n,distinct,buckets", [(1, 500, 37, 8), (2, 300, 300, 16), (3, 400, 2, 4),
                                                     (4, 50, 50, 1), (5, 1000, 5, 64)])
def test_distributed_percent_rank_equals_window(spark, seed, n, distinct, buckets):
    rnd = random.Random(seed)
    rows = [(i, Decimal(rnd.randrange(distinct)) / 4 if rnd.random() > 0.05 else None) for i in range(n)]
    # a third of all rows on one value
    rows += [(n + i, Decimal(3)) for i in range(n // 2)]
    df = spark.createDataFrame(rows, "id long, v decimal(12,2)")
    got = {r.id: r.pr for r in percent_rank(df, "v", out="pr", buckets=buckets).collect()}
    assert got == _reference_pr(spark, df, "v")


def test_tier_edges(spark):
    one = spark.createDataFrame([(1, 5.0)], "id long, v double")
    assert tier_by_percent_rank(one, "v", out="g").first().g == "5"
    ties = spark.createDataFrame([(i, 1.0) for i in range(10)], "id long, v double")
    assert {r.g for r in tier_by_percent_rank(ties, "v", out="g").collect()} == {"5"}
    d21 = spark.createDataFrame([(i, float(i)) for i in range(21)], "id long, v double")
    g = {r.id: r.g for r in tier_by_percent_rank(d21, "v", out="g").collect()}
    assert g[19] == "5"          # rank 2 of 21 -> exactly 0.05
    assert g[18] == "10" and g[0] == "50+"


# --- joins ------------------------------------------------------------------------------------------
def test_either_endpoint_join_equals_or_join(spark):
    a = spark.createDataFrame([("AAA",), ("BBB",), ("CCC",)], "code string")
    f = spark.createDataFrame([(1, "AAA", "BBB"), (2, "AAA", "AAA"), (3, None, "CCC"), (4, None, None)],
                              "fid int, dep string, arr string")
    got = sorted((r.code, r.fid) for r in either_endpoint_join(a, "code", f, "dep", "arr").collect())
    want = sorted((r.code, r.fid) for r in a.join(f, (a.code == f.dep) | (a.code == f.arr)).collect())
    assert got == want == [("AAA", 1), ("AAA", 2), ("BBB", 1), ("CCC", 3)]
    plan = either_endpoint_join(a, "code", f, "dep", "arr")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_swap_roles(spark):
    df = spark.createDataFrame([("A", "B", 3)], "a string, b string, n_out int")
    r = swap_roles(df, [("a", "b")], {"n_out": "n_in"}).first()
    assert (r.a, r.b, r.n_in) == ("B", "A", 3)


# --- scalar functions --------------------------------------------------------------------------------
def test_hash_encodings(spark):
    df = spark.createDataFrame([("ab", "c", None, True), ("a", "bc", None, False)],
                               "x string, y string, z string, b boolean")
    r = df.select(hash_columns(df, ["x", "y"], compat=True).alias("c"),
                  hash_columns(df, ["x", "y"]).alias("d"),
                  hash_columns(df, ["z", "b"], compat=True).alias("zb")).collect()
    assert r[0].c == r[1].c                     # plain concatenation collides
    assert r[0].d != r[1].d                     # delimited form does not
    import hashlib
    assert r[0].zb == hashlib.md5(b"TrueNone").hexdigest()   # sorted keys b, z; str(None), str(True)
    assert r[1].zb == hashlib.md5(b"FalseNone").hexdigest()
    one = spark.createDataFrame([("XXX",)], "airport_code string")
    assert one.select(hash_columns(one, ["airport_code"]).alias("h")).first().h == hashlib.md5(b"XXX").hexdigest()
    sid = one.select(surrogate_id(F.md5(F.lit("XXX"))).alias("s")).first().s
    assert bytes(sid) == hashlib.md5(b"XXX").digest()


def test_decimal_overflow_raises(spark):
    df = spark.createDataFrame([(Decimal("100000000.00"),)], "x decimal(12,2)")
    with pytest.raises(ArithmeticException):
        df.select(F.col("x").cast("decimal(10,2)")).collect()


def test_round_half_up_is_exact(spark):
    rnd = random.Random(7)
    pairs = [(57, 200), (1, 8), (5, 1000), (0, 3)] + [(rnd.randrange(10 ** 9), rnd.randrange(1, 10 ** 7))
                                                      for _ in range(300)]
    df = spark.createDataFrame(pairs, "p long, q long")
    got = df.select("p", "q", round_half_up_ratio(F.col("p"), F.col("q")).alias("r"),
                    percent_half_up(F.col("p"), F.col("q")).alias("pct")).collect()
    for r in got:
        want = (Decimal(r.p) / Decimal(r.q)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert Decimal(str(r.r)) == want
        wantp = (Decimal(100 * r.p) / Decimal(r.q)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert Decimal(str(r.pct)) == wantp


def test_share_of_total_sums_to_100(spark):
    df = spark.createDataFrame([(c, n) for c, n in zip("ABCDEFG", [1, 2, 3, 5, 7, 11, 13])], "k string, n long")
    s = sum(r.p for r in share_of_total(df, "n", "p").collect())
    assert abs(s - 100) <= 0.05


def test_bucket_by_thresholds(spark):
    df = spark.createDataFrame([(x,) for x in (0, 4, 5, 9, 10, 30)], "n int")
    g = [r.g for r in df.select(bucket_by_thresholds(F.col("n"), (10, 5), ("F", "R", "O")).alias("g")).collect()]
    assert g == ["O", "O", "R", "R", "F", "F"]


def test_latest_version(spark):
    df = spark.createDataFrame([(1, TS, "old"), (1, TS + dt.timedelta(days=1), "new"), (2, TS, "only")],
                               "p int, load_date timestamp, v string")
    assert {r.p: r.v for r in latest_version(df, "p").collect()} == {1: "new", 2: "only"}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_narrowing_raises_whatever_the_session_says(spark, ansi):
    from skyledger.functions.numeric import narrow
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(5, "1.25"), (None, None), (-7, "99999999.99")], "n long, m string").withColumn("m", F.col("m").cast("decimal(20,2)"))
        got = [tuple(r) for r in df.select(narrow(F.col("n"), "int"), narrow(F.col("m"), "decimal(10,2)").cast("double")).collect()]
        assert got == [(5, 1.25), (None, None), (-7, 99999999.99)]
        for bad in (narrow(F.lit(2 ** 31).cast("long"), "int"), narrow(F.lit("100000000.00").cast("decimal(20,2)"), "decimal(10,2)")):
            with pytest.raises(Exception, match="out of range"):
                df.select(bad).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


# --- change capture ---------------------------------------------------------------------------------------
def test_decode_decimal(spark):
    import base64
    def b64(n, nbytes):
        return base64.b64encode(n.to_bytes(nbytes, "big", signed=True)).decode()
    df = spark.createDataFrame([(b64(12345, 2),), (b64(-250, 2),), ("17.5",), ("-3",)], "v string")
    got = [r.d for r in df.select(cdc.decode_decimal(F.col("v")).alias("d")).collect()]
    assert got == [Decimal("123.45"), Decimal("-2.50"), Decimal("17.50"), Decimal("-3.00")]


def test_snapshot_diff_round_trip(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "k int, v string")
    d = cdc.snapshot_diff(old, new, ["k"])
    assert sorted((r.op, r.k) for r in d.collect()) == [("c", 4), ("d", 3), ("u", 2)]
    back = cdc.apply_changes(old, d, ["k"])
    assert sorted(back.collect()) == sorted(new.collect())


def test_parse_changes_filters(spark):
    feed = spark.createDataFrame([
        ("airline.public.airports", 0, 1, TS, None, '{"payload":{"op":"c","after":{"airport_code":"AAA"}}}'),
        ("airline.public.airports", 0, 1, TS, None, '{"payload":{"op":"c","after":{"airport_code":"AAA"}}}'),
        ("airline.public.airports", 0, 2, TS, None, '{"schema":{}}'),
        ("airline.public.airports", 0, 3, TS, None, "not json"),
        ("airline.public.airports", 0, 4, TS, None, None),
        ("airline.public.airports", 0, 5, TS, None, '{"payload":{"op":"r","after":{"airport_code":"BBB"}}}'),
        ("airline.public.airports", 0, 6, TS, None, '{"payload":{"op":"d","before":{"airport_code":"CCC"}}}'),
        ("airline.public.airports", 0, 7, TS, None, '{"payload":{"op":"u","after":null}}'),
    ], "topic string, partition int, offset long, timestamp timestamp, key string, value string")
    got = sorted((r.offset, r.op) for r in cdc.parse_changes(feed).collect())
    assert got == [(1, "c"), (6, "d")]
    assert sorted((r.offset, r.op) for r in cdc.parse_changes(feed, include_snapshot=True).collect()) == \
        [(1, "c"), (5, "r"), (6, "d")]
    q = sorted((r.offset, r.reject_reason) for r in cdc.quarantine(feed).collect())
    assert q == [(2, "no_payload"), (3, "malformed")]


def test_mark_changes(spark):
    from skyledger.operators.ranking import mark_changes
    df = spark.createDataFrame([(1, 1, "h1"), (1, 2, "h1"), (1, 3, "h2"), (1, 4, "h1"), (2, 1, "x")],
                               "p int, seq int, hash_diff string")
    got = sorted((r.p, r.seq, r.is_change) for r in mark_changes(df, "p", "seq").collect())
    assert got == [(1, 1, True), (1, 2, False), (1, 3, True), (1, 4, True), (2, 1, True)]


@pytest.mark.parametrize("seed,buckets", [(1, 1), (2, 7), (3, 40)])
def test_previous_value_equals_lag(spark, seed, buckets):
    """Ranges cut through the hot parent (a third of the rows), NULL parents and NULL values."""
    from skyledger.operators.ranking import previous_value
    rnd = random.Random(seed)
    rows = [(1 if i % 3 == 0 else rnd.choice([None, 2, 3, 4, 5]), i, rnd.choice([None, "a", "b"])) for i in range(400)]
    df = spark.createDataFrame(rows, "p int, seq int, h string")
    w = Window.partitionBy("p").orderBy("seq")
    expected = {r.seq: r.x for r in df.withColumn("x", F.lag("h").over(w)).collect()}
    out = previous_value(df, "p", "seq", "h", "x", buckets=buckets)
    assert out.columns == ["p", "seq", "h", "x"]
    assert {r.seq: r.x for r in out.collect()} == expected
    assert previous_value(df.limit(0), "p", "seq", "h", "x").count() == 0


def test_decode_decimal_by_encoding(spark):
    digits = "9999"                          # base64 of 3 bytes and a number at once
    df = spark.createDataFrame([(digits,), ("17.5",), ("!",), (None,)], "v string")
    text = [r.d for r in df.select(cdc.decode_decimal(F.col("v"), encoding="text").alias("d")).collect()]
    assert text == [Decimal("9999.00"), Decimal("17.50"), None, None]
    import base64
    unscaled = int.from_bytes(base64.b64decode(digits), "big", signed=True)
    b64 = [r.d for r in df.select(cdc.decode_decimal(F.col("v"), encoding="base64").alias("d")).collect()]
    assert b64[0] == Decimal(unscaled) / 100 and b64[2] is None and b64[3] is None
    amounts = spark.createDataFrame([(Decimal("-12.34"),), (Decimal("0.00"),), (Decimal("99999999.99"),), (None,)], "a decimal(10,2)")
    back = amounts.select("a", cdc.decode_decimal(cdc.encode_decimal(F.col("a")), encoding="base64").alias("b")).collect()
    assert all(r.a == r.b for r in back)
    with pytest.raises(ValueError):
        cdc.decode_decimal(F.col("v"), encoding="hex")


def test_violation_report_counts(spark):
    from skyledger.operators.quality import Constraints, violation_report
    t = {"p": spark.createDataFrame([("A", 1), ("B", 1), ("B", 2), (None, 3), (None, 4)], "code string, n int"),
         "c": spark.createDataFrame([(1, "A"), (2, None), (3, "C"), (4, "C"), (5, "")], "id int, code string"),
         "e": spark.createDataFrame([], "code string")}
    got = {r.check_name: r.violations for r in violation_report(t, Constraints(
        keys=[("pk:p", "p", ["code"]), ("pk:pn", "p", ["code", "n"]), ("pk:e", "e", ["code"])],
        references=[("fk:c", "c", ["code"], "p", ["code"]), ("fk:c.e", "c", ["code"], "e", ["code"]), ("fk:e", "e", ["code"], "p", ["code"])],
        rules=[("col:c", "c", F.col("code").isNull()), ("col:p", "p", F.col("n") > 9)])).collect()}
    assert got == {"pk:p": 2, "pk:pn": 0, "pk:e": 0, "fk:c": 3, "fk:c.e": 4, "fk:e": 0, "col:c": 1, "col:p": 0}


def test_key_checks_raise(spark):
    from skyledger.operators.quality import DataQualityError, check_foreign_key, check_unique, orphans
    parent = spark.createDataFrame([("A",), ("B",)], "code string")
    child = spark.createDataFrame([(1, "A"), (2, None), (3, "C")], "id int, code string")
    assert [r.id for r in orphans(child, ["code"], parent, ["code"]).collect()] == [3]   # NULL exempt
    with pytest.raises(DataQualityError):
        check_foreign_key(child, ["code"], parent, ["code"])
    check_unique(parent, ["code"])
    with pytest.raises(DataQualityError):
        check_unique(child.union(child), ["id"])


def test_schema_violations(spark):
    from skyledger.operators.quality import schema_violations
    df = spark.createDataFrame([("AB", None), ("ABC", "x")], "airport_code string, airport_name string")
    r = schema_violations(df, OLTP["airports"], {"airport_code": ("char", 3)}).first().asDict()
    assert r["airport_code_length"] == 1 and r["airport_name_null"] == 1 and r["airport_code_null"] == 0


def test_table_diff_multiset(spark):
    from skyledger.operators.quality import table_diff
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (3,)], "x int")
    assert sorted((r.x, r.side) for r in table_diff(a, b).collect()) == [(1, "a"), (2, "a"), (3, "b")]
