"""Ticket legs are stored by business keys; their digests are made when they are read."""

from pyspark.sql import functions as F

from skyledger.operators import commits
from skyledger.plans import dashboards, vault
from skyledger.registry import AS_OF
from skyledger.sources import fixture

from .conftest import SF_SMALL

LOAD = "2001-08-01 00:00:00"


def test_legs_store_no_digest_of_their_own(spark, scratch):
    t = fixture.airline_tables(spark, SF_SMALL)
    vault.load_vault(spark, t, scratch, 0, LOAD, buckets=4)
    for name, digests in (("link_ticket_flight", 1), ("sat_ticket_flight_details", 0)):
        raw = commits.read_table(spark, scratch, name)
        assert [f.dataType.simpleString() for f in raw.schema].count("binary") == digests
        assert not {"hash_diff", "ticket_flight_link_id", "flight_hub_id"} & set(raw.columns)
    # the same versions again are known by their digests, changed ones are not
    again = {**t, "ticket_flights": t["ticket_flights"].withColumn("amount", F.when(F.col("flight_id") % 2 == 0, F.col("amount")).otherwise(F.lit(1)).cast("decimal(10,2)"))}
    before = vault.read_vault(spark, scratch)["sat_ticket_flight_details"].count()
    new = vault.load_vault(spark, again, scratch, 1, LOAD, on_unchanged="skip")
    want = t["ticket_flights"].where("flight_id % 2 <> 0 and amount <> 1").count()
    after = vault.read_vault(spark, scratch)
    assert after["sat_ticket_flight_details"].count() == before + want and after["link_ticket_flight"].count() == before
    assert "book_ref" not in new["sat_ticket_flight_details"].columns


def test_hub_meets_the_satellite_and_not_all_links(spark):
    v = vault.build_vault(fixture.airline_tables(spark, SF_SMALL), LOAD)
    rows = dashboards.ticket_rows(v, dashboards.flight_versions(v, AS_OF))
    tree = rows._jdf.queryExecution().optimizedPlan().toString().split("\n")
    semi = [i for i, x in enumerate(tree) if "Join LeftSemi" in x and "booking_hub_id" in x]
    assert len(semi) == 1
    depth = len(tree[semi[0]]) - len(tree[semi[0]].lstrip(" :+-"))
    below = []
    for x in tree[semi[0] + 1:]:
        if len(x) - len(x.lstrip(" :+-")) <= depth:
            break
        below.append(x)
    assert not any("ticket_no" in x or "passenger_id" in x for x in below)
