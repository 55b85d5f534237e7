"""A change batch moves only what its messages need."""

from skyledger.operators import commits
from skyledger.plans import vault
from skyledger.streaming import vault_stream

from .test_history_store import feed, leg, rows_of

TABLES = ["bookings", "tickets", "ticket_flights", "boarding_passes"]


def _ticket(i):
    return [("bookings", i, {"book_ref": f"B{i}", "book_date": "2024-01-01T00:00:00", "total_amount": "9.50"}),
            ("tickets", i, {"ticket_no": f"{i:013d}", "book_ref": f"B{i}", "passenger_id": "p", "passenger_name": "N", "contact_data": "{}"})]


def test_only_tables_with_messages_take_part(spark):
    rows = feed(spark, [("ticket_flights", 0, leg(0)), ("seats", 1, {"seat_no": "1A"})])
    assert vault_stream.tables_in(rows, TABLES) == ["ticket_flights"]
    assert vault_stream.tables_in(rows.limit(0), TABLES) == [] and vault_stream.tables_in(rows, TABLES, "other") == []


def test_legs_begin_to_wait_without_a_shuffle(spark, scratch, monkeypatch):
    written, write = {}, commits.Batch._write

    def spy(self, table, rows, schema, stamp, spread=False):
        written[table] = (spread, rows._jdf.queryExecution().executedPlan().toString())
        write(self, table, rows, schema, stamp, spread)
    monkeypatch.setattr(commits.Batch, "_write", spy)
    passes = [("boarding_passes", i, {"ticket_no": f"{i:013d}", "flight_id": 7, "boarding_no": i, "seat_no": "1A"}) for i in range(5)]
    vault_stream.load_changes_batch(feed(spark, [("ticket_flights", i, leg(i)) for i in range(40)] + passes), 0, scratch, TABLES, writer="s", buckets=4)
    assert set(written) == {"waiting_ticket_flights", "waiting_boarding_passes"}
    for spread, plan in written.values():
        assert spread and "Exchange" not in plan and "InMemoryTableScan" not in plan
    stored = commits.read_runs(spark, scratch, commits.read_manifest(spark, scratch), "waiting_ticket_flights")
    assert stored.where(commits.bucket_of("ticket_no", 4) != stored["bucket"]).isEmpty() and stored.count() == 40
    # tickets later, with legs of their own and again: all meet
    later = [x for i in (1, 2, 50) for x in _ticket(i)] + [("ticket_flights", 100, {**leg(2), "flight_id": 8}), ("ticket_flights", 101, leg(50))]
    vault_stream.load_changes_batch(feed(spark, later), 1, scratch, TABLES, writer="s")
    assert vault_stream.waiting_rows(spark, scratch).count() == 38 + 3
    assert rows_of(vault.read_vault(spark, scratch)["sat_ticket_flight_details"].select("boarding_no").where("boarding_no is not null")) == [(1,), (2,)]
    assert vault.read_vault(spark, scratch)["link_ticket_flight"].count() == 4
