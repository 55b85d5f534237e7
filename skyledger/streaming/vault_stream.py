"""Structured Streaming loader: change messages -> history layer.

`readStream` (Kafka, or JSON files in tests) -> `foreachBatch`: each
micro-batch is parsed, its rejects written to a quarantine dataset, and its
row images loaded as one set-based batch (`plans.vault.load_vault`): hubs and
links insert unknown keys, satellites append versions. All tables of a batch are
committed at once, and a batch replayed after a failure takes the place of exactly its own
output: with the checkpoint this gives exactly-once results on an at-least-once
source. The writer is the id of the streaming query, which lives in its checkpoint: a
stream started on a new checkpoint is a new writer and replaces nothing.

Topics have no mutual order: legs and boarding passes whose ticket or leg is not known yet
wait as keyed rows of the same store, in the bucket of their ticket. A batch reads only
the waiting rows of tickets it holds, adds those that begin to wait and marks those that are
settled; what waits otherwise is neither read nor written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import latest_version, newest_version
from ..operators import commits
from ..operators.sinks import append_batch, staging
from ..plans import vault
from ..sources import cdc

# The reference consumes these two topics; any table of the booking model can be added.
DEFAULT_TABLES = ("airports", "aircrafts")


def vault_tables_for(tables: Sequence[str]) -> list[str]:
    """History tables fed by the given source tables."""
    avail = set(tables) | ({"ticket_legs"} if {"ticket_flights", "boarding_passes"} & set(tables) else set())
    out = [h.name for h in vault.HUBS if h.source in avail]
    out += [lk.name for lk in vault.LINKS if lk.source in avail]
    out += [s.name for s in vault.SATELLITES if s.source in avail]
    return out


LEG_KEYS = ["ticket_no", "flight_id"]
# message times tie within a millisecond: the place in the topic decides then
MESSAGE_ORDER = ["_load_ts", "_partition", "_offset"]


def _leg_rows(src) -> DataFrame | None:
    """(ticket_no, flight_id) of this batch's ticket_flights and boarding_passes images."""
    parts = [src[n].select(*LEG_KEYS) for n in ("ticket_flights", "boarding_passes") if n in src]
    if not parts:
        return None
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def _near(stored, table: str, rows: DataFrame) -> DataFrame | None:
    """Stored rows of a table in the buckets of the keys of `rows` (nothing is stored: None)."""
    if not stored:
        return None
    return vault.near(stored, table, rows) if table in vault.TABLES else stored.near(table, rows)


def ticket_keys(src, stored, wanted: DataFrame | None = None) -> DataFrame | None:
    """ticket_no -> (book_ref, passenger_id): from this batch's tickets images and, for
    the tickets of `wanted` (rows with ticket_no) loaded earlier, from the stored link and
    hubs (latest wins). `stored` is the batch that is loaded, or nothing."""
    parts = []
    if "tickets" in src:
        parts.append(src["tickets"].select("ticket_no", "book_ref", "passenger_id", *MESSAGE_ORDER))
    link = _near(stored, "link_ticket_booking", wanted) if wanted is not None else None
    if link is not None:
        link = vault.stored_for_batch(link, wanted, ["ticket_no"])
        link = link.select("ticket_no", "booking_hub_id", "passenger_hub_id", F.col("load_date").alias("_load_ts"))
        hb, hp = _near(stored, "hub_bookings", link), _near(stored, "hub_passengers", link)
        if hb is not None and hp is not None:
            parts.append(link.join(hb.select("booking_hub_id", "book_ref"), "booking_hub_id")
                         .join(hp.select("passenger_hub_id", "passenger_id"), "passenger_hub_id")
                         .select("ticket_no", "book_ref", "passenger_id", "_load_ts",
                                 F.lit(-1).alias("_partition"), F.lit(-1).cast("long").alias("_offset")))
    if not parts:
        return None
    keys = parts[0]
    for p in parts[1:]:
        keys = keys.unionByName(p)
    return latest_version(keys, "ticket_no", MESSAGE_ORDER).drop(*MESSAGE_ORDER)


def stream_ticket_legs(src, stored) -> DataFrame | None:
    """Ticket legs (source of link_ticket_flight and its satellite) of one batch.

    A ticket_flights image gets its ticket's booking and passenger (this batch
    or stored) and the boarding pass of this batch, else the one of the current
    stored version. A boarding pass arriving without its ticket_flights row
    yields a new version carrying the current fare and amount.
    """
    batch_legs = _leg_rows(src)
    if batch_legs is None:
        return None
    keys = ticket_keys(src, stored, batch_legs)
    if keys is None:
        return None
    link_id = vault.ref_id("link_ticket_flight")
    # only the current versions of this batch's ticket legs are read
    ids = batch_legs.join(keys, "ticket_no").select("ticket_no", link_id.alias("ticket_flight_link_id"))
    past, current = _near(stored, "sat_ticket_flight_details", ids), None
    if past is not None:
        past = vault.stored_for_batch(past, ids, ["ticket_flight_link_id"])
        current = newest_version(past, "ticket_flight_link_id").select(
            "ticket_flight_link_id", F.col("fare_conditions").alias("_cur_fare"), F.col("amount").alias("_cur_amount"),
            F.col("boarding_no").alias("_cur_boarding"), F.col("seat_no").alias("_cur_seat"))
    bp = None
    if "boarding_passes" in src:
        # partitioned by ticket once, for the grouping by leg, that by ticket and the join
        bp = latest_version(src["boarding_passes"].select(*LEG_KEYS, "boarding_no", "seat_no", *MESSAGE_ORDER).repartition("ticket_no"),
                            LEG_KEYS, MESSAGE_ORDER)
    legs = []
    if "ticket_flights" in src:
        tf = src["ticket_flights"].select(*LEG_KEYS, "fare_conditions", "amount", "_load_ts").join(keys, "ticket_no")
        if bp is not None:
            # a ticket's few passes as one row: legs and passes lie by ticket already and are not shuffled by leg
            passes = bp.groupBy("ticket_no").agg(F.collect_list(F.struct("flight_id", "boarding_no", "seat_no")).alias("_passes"))
            own = F.get(F.filter("_passes", lambda p: p["flight_id"] == F.col("flight_id")), F.lit(0))
            tf = (tf.join(passes, "ticket_no", "left").withColumn("_pass", own)
                  .withColumns({"boarding_no": F.col("_pass.boarding_no"), "seat_no": F.col("_pass.seat_no")}).drop("_passes", "_pass"))
        else:
            tf = tf.withColumns({"boarding_no": F.lit(None).cast("int"), "seat_no": F.lit(None).cast("string")})
        if current is not None:
            tf = (tf.withColumn("ticket_flight_link_id", link_id).join(current, "ticket_flight_link_id", "left")
                  .withColumns({"boarding_no": F.coalesce("boarding_no", "_cur_boarding"),
                                "seat_no": F.coalesce("seat_no", "_cur_seat")}))
        legs.append(tf.select(*LEG_KEYS, "book_ref", "passenger_id", "fare_conditions", "amount",
                              "boarding_no", "seat_no", "_load_ts"))
    if bp is not None and current is not None:
        only_bp = bp.join(src["ticket_flights"].select(*LEG_KEYS), LEG_KEYS, "left_anti") \
            if "ticket_flights" in src else bp
        b = (only_bp.join(keys, "ticket_no").withColumn("ticket_flight_link_id", link_id)
             .join(current, "ticket_flight_link_id"))
        legs.append(b.select(*LEG_KEYS, "book_ref", "passenger_id", F.col("_cur_fare").alias("fare_conditions"),
                             F.col("_cur_amount").alias("amount"), "boarding_no", "seat_no", "_load_ts"))
    if not legs:
        return None
    out = legs[0]
    for x in legs[1:]:
        out = out.unionByName(x)
    return out


WAITING_COLUMNS = {"ticket_flights": [*LEG_KEYS, "fare_conditions", "amount", *MESSAGE_ORDER],
                   "boarding_passes": [*LEG_KEYS, "boarding_no", "seat_no", *MESSAGE_ORDER]}


def waiting_rows(spark: SparkSession, root: str, before: str | None = None) -> DataFrame | None:
    """Legs and passes that wait for their ticket or leg (sent before a time, to find those whose ticket
    never comes): table, ticket_no, flight_id, waiting_since, writer."""
    out = None
    for name in WAITING_COLUMNS:
        rows = commits.read_table(spark, root, f"waiting_{name}")
        if rows is None:
            continue
        settled = commits.read_table(spark, root, f"settled_{name}")
        if settled is not None:
            rows = rows.join(settled.select(*vault.WAITING_KEY), vault.WAITING_KEY, "left_anti")
        rows = rows.select(F.lit(name).alias("table"), *LEG_KEYS, F.col("_load_ts").alias("waiting_since"), "writer")
        out = rows if out is None else out.unionByName(rows)
    return out.where(F.col("waiting_since") < F.lit(before).cast("timestamp")) if out is not None and before else out


def read_waiting(batch: commits.Batch, src) -> dict[str, DataFrame]:
    """What this writer has waiting for the tickets of a batch (by the tickets' buckets)."""
    arrived = None
    for name in ("tickets", *WAITING_COLUMNS):
        if name in src:
            keys = src[name].select("ticket_no")
            arrived = keys if arrived is None else arrived.unionByName(keys)
    out = {}
    for name, columns in WAITING_COLUMNS.items():
        rows = _near(batch, f"waiting_{name}", arrived)
        if rows is None:
            continue
        rows = vault.stored_for_batch(rows.where(F.col("writer") == F.lit(batch.writer)), arrived, ["ticket_no"])
        settled = _near(batch, f"settled_{name}", arrived)
        if settled is not None:
            rows = rows.join(settled.select(*vault.WAITING_KEY), vault.WAITING_KEY, "left_anti")
        out[name] = rows.select(*columns)
    return out


def write_waiting(batch: commits.Batch, src, waited: dict[str, DataFrame], legs: DataFrame | None) -> None:
    """Rows of the batch that led to no ticket leg begin to wait; rows that waited and led to one are settled."""
    # by ticket, as the waiting rows and the legs lie: no shuffle by leg
    done = None if legs is None else legs.groupBy("ticket_no").agg(F.collect_set("flight_id").alias("_done"))
    led = F.coalesce(F.array_contains("_done", F.col("flight_id")), F.lit(False))
    for name, columns in WAITING_COLUMNS.items():
        if name in src:
            rows = src[name].select(*columns)
            # each task sorts its rows into buckets: they are shuffled by ticket when it arrives, not for the wait
            batch.write(f"waiting_{name}", rows if done is None else rows.join(done, "ticket_no", "left").where(~led).drop("_done"), spread=True)
        if name in waited and done is not None:
            rows = waited[name].join(done, "ticket_no").where(led).select(*[c for c in vault.WAITING_KEY if c != "writer"])
            batch.write(f"settled_{name}", batch.aligned(rows, F.col("ticket_no")), spread=True)


def with_waiting(src, waited: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Sources of a batch with the rows that waited for it."""
    out = dict(src)
    for name, rows in waited.items():
        own = src[name].select(*rows.columns) if name in src else None
        out[name] = rows if own is None else own.unionByName(rows)
    return out


def change_sources(changes: DataFrame, tables: Sequence[str], include_snapshot: bool = False,
                   prefix: str = cdc.TOPIC_PREFIX, decimals: str = "auto") -> dict[str, DataFrame]:
    """Row images per table that produce history rows: creates and updates
    (and snapshot reads if asked). Deletes add nothing (history is kept)."""
    ops = ["c", "u"] + (["r"] if include_snapshot else [])
    return {t: cdc.typed_images(changes, t, prefix, decimals).where(F.col("_op").isin(*ops)) for t in tables}


def tables_in(feed: DataFrame, tables: Sequence[str], prefix: str = cdc.TOPIC_PREFIX) -> list[str]:
    """Those of `tables` that the feed holds a message of (one topic name each comes to the driver)."""
    found = feed.where(F.col("topic").isin(*[cdc.topic_of(t, prefix) for t in tables])).select("topic").distinct().collect()
    return [t for t in tables if cdc.topic_of(t, prefix) in {r["topic"] for r in found}]


def load_changes_batch(batch: DataFrame, batch_id: int, root: str, tables: Sequence[str] = DEFAULT_TABLES,
                       on_unchanged: str = "append", include_snapshot: bool = False,
                       quarantine_path: str | None = None, prefix: str = cdc.TOPIC_PREFIX,
                       writer: str = "stream", decimals: str = "auto", buckets: int = commits.BUCKETS) -> None:
    """Load one batch of feed rows. The batch is staged as compressed files; messages are parsed and typed once per
    source table: up to six history tables and the waiting rows read the kept images."""
    with staging(batch, "feed") as rows:
        _load_staged(rows, batch_id, root, tables, on_unchanged, include_snapshot, quarantine_path, prefix, writer, decimals, buckets)


def _load_staged(staged: DataFrame, batch_id: int, root: str, tables: Sequence[str], on_unchanged: str, include_snapshot: bool,
                 quarantine_path: str | None, prefix: str, writer: str, decimals: str, buckets: int) -> None:
    spark = staged.sparkSession
    kept = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df.persist())
        return kept[-1]
    try:
        if staged.isEmpty():  # a trigger that only moves the stream's time
            return
        # few batches hold a message twice: those of others are neither joined nor shuffled
        changes = cdc.parse_changes(staged, include_snapshot, once=not cdc.has_redelivered(staged))
        if quarantine_path:
            rejects = cdc.quarantine(staged).unionByName(cdc.image_rejects(changes, tables, prefix, decimals))
            append_batch(rejects, quarantine_path, batch_id, writer=writer)
        load = vault.begin_batch(spark, root, writer, batch_id, buckets)
        # a table without a message in this batch takes no part in its plans
        src = change_sources(changes, tables_in(staged, tables, prefix), include_snapshot, prefix, decimals)
        # legs and passes for which no ticket can be known only begin to wait: they are read once
        no_tickets = "tickets" not in src and not load.holds("link_ticket_booking")
        src = {t: df if no_tickets and t in WAITING_COLUMNS else keep(df) for t, df in src.items()}
        if {"ticket_flights", "boarding_passes"} & set(tables):
            waited = {name: keep(rows) for name, rows in read_waiting(load, src).items()}
            legs = stream_ticket_legs(with_waiting(src, waited), load)
            legs = None if legs is None else keep(legs)
            write_waiting(load, src, waited, legs)
            src = {k: v for k, v in src.items() if k not in ("ticket_flights", "boarding_passes")}
            if legs is not None:
                src["ticket_legs"] = legs
        vault.write_batch(load, src, None, on_unchanged, vault_tables_for(tables))
        load.commit()
    finally:
        for df in kept:
            df.unpersist()


def start_vault_stream(feed: DataFrame, root: str, checkpoint: str, tables: Sequence[str] = DEFAULT_TABLES,
                       on_unchanged: str = "append", include_snapshot: bool = False,
                       quarantine_path: str | None = None, available_now: bool = True,
                       processing_time: str | None = None, query_name: str | None = None,
                       decimals: str = "auto", buckets: int = commits.BUCKETS, redelivery_window: str | None = "1 hour"):
    """Start the streaming load; `feed` is a streaming DataFrame of feed rows. Messages delivered again within
    `redelivery_window` are dropped by the stream's state, later ones by the load itself (None: all)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        # the query's id is kept in its checkpoint: the same after a restart, new on a new checkpoint
        writer = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"
        load_changes_batch(batch, batch_id, root, tables, on_unchanged, include_snapshot, quarantine_path,
                           writer=writer, decimals=decimals, buckets=buckets)

    if not quarantine_path:  # messages of other topics load nothing: without a report of rejects they are not kept
        feed = feed.where(F.col("topic").isin(*[cdc.topic_of(t) for t in tables]))
    if redelivery_window:
        feed = cdc.watch_redelivery(feed, redelivery_window)
    w = feed.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def batch_load_from_feed(spark: SparkSession, feed: DataFrame, tables: Sequence[str] = DEFAULT_TABLES,
                         include_snapshot: bool = False) -> dict[str, DataFrame]:
    """The history rows one batch of `feed` produces on an empty layer (lazy):
    the same plan the stream runs per micro-batch, as a static DataFrame."""
    changes = cdc.parse_changes(feed, include_snapshot)
    src = change_sources(changes, tables, include_snapshot)
    if {"ticket_flights", "boarding_passes"} & set(tables):
        legs = stream_ticket_legs(src, {})
        src = {k: v for k, v in src.items() if k not in ("ticket_flights", "boarding_passes")}
        if legs is not None:
            src["ticket_legs"] = legs
    return vault.build_vault(src, None, vault_tables_for(tables))
