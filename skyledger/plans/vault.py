"""History layer (Data Vault): 5 hubs, 3 links, 6 satellites from one spec table.

Keys
  hub hash key   = MD5 of the business key text (as the reference computes it)
  link hash key  = record hash of all business keys of its endpoints
  surrogate ids  = the hash key as 16 bytes (`surrogate_id`), so a link
                   gets its hub / link references from business keys with no
                   look-up join and no load-order dependency
  hash_diff      = record hash of parent business key + satellite payload

Batch form (`build_vault`): every table as a lazy DataFrame over the booking
model. Incremental form (`load_vault`): per batch, hubs and links insert only
unknown keys (anti-join against what is stored), satellites append a version
(all, as the reference does, or only changed ones). All tables of a batch appear at
once (`operators.commits`), a batch looks only into the buckets of its own keys, and a
repeated batch takes the place of the former one and of nothing of another writer (a
backfill next to a stream).

Stored form: the hash key of a hub or link is the hex text of its id and is not stored
(`shown` adds it when the table is read), a hash_diff is stored as its 16 bytes. Ticket legs
and their details are stored with the leg's business keys, which sorted by ticket take a few
bytes a row; their ids, hash keys and hash_diff, random bytes that do not compress, are
digests of what is stored and are made again by `shown`. They lie in the bucket of their
ticket number: the joins that make them partition them by it, and they are written from there
without another shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.keys import (RECORD_SOURCE, SOURCE_SYSTEM_ID, hash_columns, hash_sql, surrogate_id,
                              surrogate_id_sql, with_lineage)
from ..lazy import LazyTables
from ..operators.ranking import latest_version, newest_version, previous_value
from ..schemas import LINEAGE
from ..operators import commits
from ..operators.sinks import insert_if_absent
from ..operators.sizing import shuffle_partitions

TABLES_AT_ONCE = 4  # tables of a batch written side by side

LINEAGE_COLS = [name for name, _, _ in LINEAGE]


@dataclass(frozen=True)
class Hub:
    name: str
    source: str
    key: str
    id_col: str
    hash_col: str


@dataclass(frozen=True)
class Link:
    name: str
    source: str
    id_col: str
    hash_col: str
    key_cols: tuple[str, ...]                 # business keys hashed into the link key
    refs: tuple[tuple[str, str], ...]         # (output id column, hub or link name)
    degenerate: tuple[str, ...] = ()


@dataclass(frozen=True)
class Satellite:
    name: str
    source: str
    parent: str                               # hub or link name
    payload: tuple[str, ...]
    version_order: tuple[str, ...] = field(default_factory=tuple)  # pick one row per parent and batch


HUBS = [
    Hub("hub_airports", "airports", "airport_code", "airport_hub_id", "airport_hash_key"),
    Hub("hub_aircrafts", "aircrafts", "aircraft_code", "aircraft_hub_id", "aircraft_hash_key"),
    Hub("hub_passengers", "tickets", "passenger_id", "passenger_hub_id", "passenger_hash_key"),
    Hub("hub_bookings", "bookings", "book_ref", "booking_hub_id", "booking_hash_key"),
    Hub("hub_flights", "flights", "flight_id", "flight_hub_id", "flight_hash_key"),
]
LINKS = [
    Link("link_flight_leg", "flights", "flight_leg_link_id", "flight_leg_hash_key",
         ("flight_id", "departure_airport", "arrival_airport", "aircraft_code"),
         (("flight_hub_id", "hub_flights"), ("departure_airport_hub_id", "hub_airports:departure_airport"),
          ("arrival_airport_hub_id", "hub_airports:arrival_airport"), ("aircraft_hub_id", "hub_aircrafts"))),
    Link("link_ticket_booking", "tickets", "ticket_booking_link_id", "ticket_booking_hash_key",
         ("book_ref", "passenger_id", "ticket_no"),
         (("booking_hub_id", "hub_bookings"), ("passenger_hub_id", "hub_passengers")), ("ticket_no",)),
    Link("link_ticket_flight", "ticket_legs", "ticket_flight_link_id", "ticket_flight_hash_key",
         ("book_ref", "passenger_id", "ticket_no", "flight_id"),
         (("ticket_booking_link_id", "link_ticket_booking"), ("flight_hub_id", "hub_flights"))),
]
SATELLITES = [
    Satellite("sat_airport_details", "airports", "hub_airports",
              ("airport_name", "city", "coordinates_lon", "coordinates_lat", "timezone")),
    Satellite("sat_aircraft_details", "aircrafts", "hub_aircrafts", ("model", "range")),
    Satellite("sat_passenger_details", "tickets", "hub_passengers", ("passenger_name", "contact_data"),
              version_order=("ticket_no",)),
    Satellite("sat_booking_details", "bookings", "hub_bookings", ("book_date", "total_amount")),
    Satellite("sat_flight_details", "flights", "hub_flights",
              ("flight_no", "scheduled_departure", "scheduled_arrival", "status",
               "actual_departure", "actual_arrival")),
    Satellite("sat_ticket_flight_details", "ticket_legs", "link_ticket_flight",
              ("fare_conditions", "amount", "boarding_no", "seat_no")),
]
HUB_BY_NAME = {h.name: h for h in HUBS}
LINK_BY_NAME = {lk.name: lk for lk in LINKS}
TABLES = [h.name for h in HUBS] + [lk.name for lk in LINKS] + [s.name for s in SATELLITES]


# --- reference columns ------------------------------------------------------------
def hub_key_hash(c: Column) -> Column:
    """Hub hash key of one business key value (MD5 of its text)."""
    return F.md5(c.cast("string"))


def _hub_hash_sql(col: str) -> str:
    return f"md5(CAST(`{col}` AS STRING))"


def ref_id(target: str, src_col: str | None = None) -> Column:
    """Surrogate id of the hub / link a source row refers to (NULL key -> NULL)."""
    if target in LINK_BY_NAME:
        return F.expr(surrogate_id_sql(hash_sql(LINK_BY_NAME[target].key_cols)))
    col = src_col or HUB_BY_NAME[target].key
    return F.expr(f"CASE WHEN `{col}` IS NOT NULL THEN {surrogate_id_sql(_hub_hash_sql(col))} END")


def link_key_hash(lk: Link) -> Column:
    return F.expr(hash_sql(lk.key_cols))


def _parse_ref(ref: str) -> tuple[str, str | None]:
    name, _, col = ref.partition(":")
    return name, (col or None)


# --- sources ------------------------------------------------------------------------
def sources(t) -> LazyTables:
    """Booking-model tables plus `ticket_legs` (ticket_flights with the ticket's booking and
    passenger, and its boarding pass if any) and their keys when its inputs exist."""
    factories = {n: (lambda n=n: t[n]) for n in t}
    if "ticket_legs" not in t and {"tickets", "ticket_flights", "boarding_passes"} <= set(t):
        n = shuffle_partitions(t["ticket_flights"])  # legs lie by ticket in as many partitions as their size asks

        def with_ticket(legs):
            return legs.repartition(n, "ticket_no").join(t["tickets"].select("ticket_no", "book_ref", "passenger_id"), "ticket_no")

        def legs():
            bp = t["boarding_passes"].select("ticket_no", "flight_id", "boarding_no", "seat_no")
            # the pass first: both sides may come grouped by the leg's key already
            return with_ticket(t["ticket_flights"].join(bp, ["ticket_no", "flight_id"], "left"))
        factories["ticket_legs"] = legs
        # for the link, whose keys the passes do not add to
        factories["ticket_leg_keys"] = lambda: with_ticket(t["ticket_flights"].select("ticket_no", "flight_id"))
    return LazyTables(factories)


def link_source(lk: Link, src) -> DataFrame:
    """Rows with the keys of a link."""
    return src["ticket_leg_keys"] if lk.source == "ticket_legs" and "ticket_leg_keys" in src else src[lk.source]


def _load_col(src: DataFrame, load_ts) -> Column:
    """Load time: the given batch time, else each change message's own time."""
    if load_ts is not None:
        return F.lit(load_ts).cast("timestamp") if not isinstance(load_ts, Column) else load_ts
    return F.col("_load_ts")


# --- batch builders ---------------------------------------------------------------
# `spread(rows, key)` may deal the rows to the buckets of the table's key. It is applied to the business
# columns, before the digests that make stored rows three times as wide are computed from them.
Spread = Callable[[DataFrame, Column], DataFrame]


def _as_is(rows: DataFrame, key: Column) -> DataFrame:
    return rows


def build_hub(h: Hub, src: DataFrame, load_ts, spread: Spread = _as_is) -> DataFrame:
    """One row per non-NULL business key (first load time when messages carry their own)."""
    hk = hub_key_hash(F.col(h.key))
    rows = src.where(F.col(h.key).isNotNull())
    if load_ts is None:
        keys = spread(rows.groupBy(h.key).agg(F.min("_load_ts").alias("load_date")), surrogate_id(hk))
        out = keys.select(surrogate_id(hk).alias(h.id_col), hk.alias(h.hash_col), h.key, "load_date")
        return out.withColumns({"record_source": F.lit(RECORD_SOURCE),
                                "source_system_id": F.lit(SOURCE_SYSTEM_ID).cast("int")})
    keys = spread(rows.select(h.key).distinct(), surrogate_id(hk))
    return with_lineage(keys.select(surrogate_id(hk).alias(h.id_col), hk.alias(h.hash_col), h.key), load_ts)


def build_link(lk: Link, src: DataFrame, load_ts, spread: Spread = _as_is, keyed: bool = False) -> DataFrame:
    """One row per combination of the link's business keys (`keyed=True`: with those)."""
    key = bucket_key(lk.name)
    cols = [surrogate_id(link_key_hash(lk)).alias(lk.id_col), link_key_hash(lk).alias(lk.hash_col)]
    for out, ref in lk.refs:
        name, col = _parse_ref(ref)
        cols.append(ref_id(name, col).alias(out))
    cols += [F.col(c) for c in (lk.key_cols if keyed else lk.degenerate)]
    if "_first" in src.columns:  # spread already, with its first row of each key marked
        return with_lineage(src.where("_first").select(*cols, "bucket"), load_ts)

    def dealt(rows: DataFrame, *more: str) -> DataFrame:
        rows = spread(rows, key)
        # a key that the table does not store: its bucket goes along
        bucket = ["bucket"] if "bucket" in rows.columns and lk.name in LEG_TABLES else []
        return rows.select(*cols, *more, *bucket)
    if load_ts is None:
        rows = dealt(src.groupBy(*lk.key_cols).agg(F.min("_load_ts").alias("load_date")), "load_date")
        return rows.withColumns({"record_source": F.lit(RECORD_SOURCE),
                                 "source_system_id": F.lit(SOURCE_SYSTEM_ID).cast("int")})
    return with_lineage(dealt(src.select(*lk.key_cols).distinct()), load_ts)


def parent_id(sat: Satellite) -> str:
    """Column with the id of a satellite's hub or link."""
    return HUB_BY_NAME[sat.parent].id_col if sat.parent in HUB_BY_NAME else LINK_BY_NAME[sat.parent].id_col


def _parent_cols(sat: Satellite) -> tuple[str, list[str], Column]:
    """(parent id column, parent business key columns, parent id expression)."""
    if sat.parent in HUB_BY_NAME:
        h = HUB_BY_NAME[sat.parent]
        return h.id_col, [h.key], ref_id(h.name)
    lk = LINK_BY_NAME[sat.parent]
    return lk.id_col, list(lk.key_cols), ref_id(lk.name)


def build_satellite(sat: Satellite, src: DataFrame, load_ts, spread: Spread = _as_is, keyed: bool = False) -> DataFrame:
    """One version per parent and load (batch), or one per change message (stream); `keyed=True`: with the parent's
    business keys."""
    pid, keys, pexpr = _parent_cols(sat)
    extra = ["_load_ts"] if load_ts is None else []
    spread_already = ["bucket"] if "bucket" in src.columns else []
    rows = src.select(*keys, *sat.payload, *extra, *spread_already)
    if sat.version_order and load_ts is not None:
        rows = latest_version(src.select(*keys, *sat.payload, *[c for c in sat.version_order if c not in keys]),
                              keys, list(sat.version_order)).select(*keys, *sat.payload)
    if load_ts is None:
        # a redelivered message repeats (keys, payload, load time) and so the whole row: keep it once
        rows = rows.distinct()
    rows = rows if spread_already else spread(rows, bucket_key(sat.name))
    # a key that the table does not store: its bucket goes along
    bucket = ["bucket"] if "bucket" in rows.columns and BUCKET_KEYS[sat.name] != pid else []
    more = [*(keys if keyed else []), *bucket]
    out = rows.select(pexpr.alias(pid), *sat.payload, *extra, *more,
                      hash_columns(rows, [*keys, *sat.payload]).alias("hash_diff"))
    out = with_lineage(out, _load_col(out, load_ts)).drop(*extra)
    return out.select(pid, "load_date", *sat.payload, "record_source", "source_system_id", "hash_diff", *more)


def build_vault(t, load_ts, tables: list[str] | None = None, spread: Callable[[str], Spread] = lambda name: _as_is,
                keyed: tuple[str, ...] = ()) -> LazyTables:
    """History tables for one load of the booking model (lazy: each table's
    plan is built when first used).

    `load_ts=None` means the sources are change images that carry their own
    message time in `_load_ts`. Only tables whose source is present are built;
    those in `keyed` carry their business keys besides.
    """
    src = sources(t)
    want = set(tables or TABLES)
    factories = {}
    for h in HUBS:
        if h.name in want and h.source in src:
            factories[h.name] = (lambda h=h: build_hub(h, src[h.source], load_ts, spread(h.name)))
    for lk in LINKS:
        if lk.name in want and lk.source in src:
            factories[lk.name] = (lambda lk=lk: build_link(lk, link_source(lk, src), load_ts, spread(lk.name), lk.name in keyed))
    for s in SATELLITES:
        if s.name in want and s.source in src:
            factories[s.name] = (lambda s=s: build_satellite(s, src[s.source], load_ts, spread(s.name), s.name in keyed))
    return LazyTables(factories)


# --- incremental load -------------------------------------------------------------------
# made of ticket legs; stored with the leg's business keys
LEG_TABLES = ("link_ticket_flight", "sat_ticket_flight_details")
# the key by which a stored table is dealt to buckets and looked up
BUCKET_KEYS = {**{h.name: h.id_col for h in HUBS}, **{lk.name: lk.id_col for lk in LINKS}, "link_ticket_booking": "ticket_no",
               **{s.name: parent_id(s) for s in SATELLITES}, **{t: "ticket_no" for t in LEG_TABLES},
               **{f"{state}_{rows}": "ticket_no" for state in ("waiting", "settled") for rows in ("ticket_flights", "boarding_passes")}}
# order of stored rows inside a bucket: a parent's versions by time, legs by ticket
ORDER = {**{s.name: [parent_id(s), "load_date"] for s in SATELLITES}, "link_ticket_flight": ["ticket_no", "flight_id"],
         "sat_ticket_flight_details": ["ticket_no", "flight_id", "load_date"]}
# one waiting row: its place in the topic tells it from others of the same leg
WAITING_KEY = ["ticket_no", "flight_id", "_partition", "_offset", "writer"]


def bucket_key(table: str) -> Column:
    """The bucket key of a hub, link or satellite from the business columns of a source row."""
    if BUCKET_KEYS[table] == "ticket_no":
        return F.col("ticket_no")
    if table in HUB_BY_NAME or table in LINK_BY_NAME:
        return ref_id(table)
    return ref_id(next(s.parent for s in SATELLITES if s.name == table))


def leg_digests(table: str) -> list[str]:
    """Columns of a leg table that are digests of the leg's business keys and its other columns. The id of the
    ticket's link is stored: legs of a ticket share it."""
    if table in LINK_BY_NAME:
        lk = LINK_BY_NAME[table]
        return [lk.id_col, lk.hash_col, "flight_hub_id"]
    return [parent_id(next(s for s in SATELLITES if s.name == table)), "hash_diff"]


def packed(table: str, rows: DataFrame) -> DataFrame:
    """Rows of a hub, link or satellite as they are stored (those of legs come with their business keys)."""
    if table in LEG_TABLES:
        return rows.drop(*leg_digests(table))
    if table in HUB_BY_NAME or table in LINK_BY_NAME:
        return rows.drop((HUB_BY_NAME.get(table) or LINK_BY_NAME[table]).hash_col)
    return rows.withColumn("hash_diff", F.unhex("hash_diff"))


def shown(table: str, rows: DataFrame) -> DataFrame:
    """Stored rows of a hub, link or satellite with all their columns."""
    lineage, stamps = ["record_source", "source_system_id"], [c for c in ("writer", "batch_id") if c in rows.columns]
    if table in LEG_TABLES and table in LINK_BY_NAME:
        lk = LINK_BY_NAME[table]
        return rows.select(ref_id(table).alias(lk.id_col), link_key_hash(lk).alias(lk.hash_col), "ticket_booking_link_id",
                           ref_id("hub_flights").alias("flight_hub_id"), "load_date", *lineage, *stamps)
    if table in LEG_TABLES:
        sat = next(s for s in SATELLITES if s.name == table)
        pid, keys, pexpr = _parent_cols(sat)
        return rows.select(pexpr.alias(pid), "load_date", *sat.payload, *lineage,
                           hash_columns(rows, [*keys, *sat.payload]).alias("hash_diff"), *stamps)
    if table in HUB_BY_NAME or table in LINK_BY_NAME:
        x = HUB_BY_NAME.get(table) or LINK_BY_NAME[table]
        return rows.select(x.id_col, F.lower(F.hex(x.id_col)).alias(x.hash_col), *[c for c in rows.columns if c != x.id_col])
    return rows.withColumn("hash_diff", F.lower(F.hex("hash_diff")))


def begin_batch(spark: SparkSession, root: str, writer: str, batch_id: int, buckets: int = commits.BUCKETS) -> commits.Batch:
    return commits.Batch(spark, root, writer, batch_id, BUCKET_KEYS, buckets, ORDER)


def near(batch: commits.Batch, table: str, rows: DataFrame) -> DataFrame | None:
    """`batch.near` of a hub, link or satellite, with all its columns."""
    stored = batch.near(table, rows)
    return None if stored is None else shown(table, stored)


def read_vault(spark: SparkSession, root: str, before_batch: int | None = None, writer: str = "batch") -> LazyTables:
    """Committed history tables; `before_batch` hides the batches >= n of `writer`. What other writers
    committed is always seen, nothing of a batch that did not finish is."""
    m = commits.read_manifest(spark, root)
    if before_batch is not None:
        m = commits.replace(m, runs=tuple(r for r in m.runs if r.writer != writer or r.batch_id < before_batch))
    found = {t for r in m.runs for t in r.tables}
    return LazyTables({n: (lambda n=n: shown(n, commits.read_runs(spark, root, m, n).drop("run", "bucket", "writer", "batch_id")))
                       for n in TABLES if n in found})


def compact_vault(spark: SparkSession, root: str, fan: int = 8) -> commits.Manifest:
    """Merge small batches (`commits.compact`): satellites sorted by parent and load date; waiting rows that were
    settled go, both in the merged runs."""
    def reduce(table: str, rows: dict[str, DataFrame]) -> DataFrame:
        state, _, kind = table.partition("_")
        other = {"waiting": "settled", "settled": "waiting"}.get(state, "") + f"_{kind}"
        return rows[table].join(rows[other].select(*WAITING_KEY), WAITING_KEY, "left_anti") if other in rows else rows[table]
    return commits.compact(spark, root, BUCKET_KEYS, fan, ORDER, reduce)


def new_satellite_rows(sat: Satellite, rows: DataFrame, stored: DataFrame | None,
                       on_unchanged: str = "append") -> DataFrame:
    """Versions to append. "append": every incoming version (the reference's
    behaviour) except exact repeats of a stored one (same parent, load time and
    hash: a redelivered message). "skip": also versions equal to the parent's
    latest stored version (the intended use of hash_diff)."""
    pid = parent_id(sat)
    if stored is not None:
        rows = rows.join(stored.select(pid, "load_date", "hash_diff"), [pid, "load_date", "hash_diff"], "left_anti")
    if on_unchanged == "append":
        return rows
    # each version against its predecessor; the parent's current stored
    # version (only for parents in this batch) seeds the sequence
    seq = rows.withColumn("_new", F.lit(True))
    if stored is not None:
        current = newest_version(stored.select(pid, "load_date", "hash_diff"), pid)
        current = current.join(rows.select(pid).distinct(), pid, "left_semi").withColumn("_new", F.lit(False))
        seq = seq.unionByName(current, allowMissingColumns=True)
    seq = previous_value(seq, pid, ["load_date", "_new"], "hash_diff", "_prev")
    keep = F.col("_new") & (F.col("_prev").isNull() | (F.col("_prev") != F.col("hash_diff")))
    return seq.where(keep).drop("_prev", "_new")


def stored_for_batch(stored: DataFrame, rows: DataFrame, cols: list[str]) -> DataFrame:
    """The part of a stored table whose `cols` occur in this batch.

    Only these rows go into the anti-joins that follow. Spark picks the join by
    its own size statistics (a small batch's keys are broadcast by AQE).
    """
    keys = rows.select(*cols).distinct()
    return stored.join(keys, cols, "left_semi")


def write_batch(batch: commits.Batch, t, load_ts, on_unchanged: str = "append", tables: list[str] | None = None) -> dict[str, DataFrame]:
    """The new rows of one batch, written but not committed. Only the buckets of the batch's keys are read. The tables
    do not need each other: TABLES_AT_ONCE are written side by side, so that small ones do not queue. Ticket legs are
    joined once for the tables made of them and, where nothing of them is stored, spread once for both."""
    def all_new(name: str) -> bool:
        return not batch.holds(name) and (on_unchanged == "append" or name in HUB_BY_NAME or name in LINK_BY_NAME)

    src, legs = sources(t), None
    # legs that are joined here come in as many partitions
    parts = shuffle_partitions(t["ticket_flights"]) if "ticket_legs" in src and "ticket_legs" not in t else None
    wanted = [x.name for x in [*LINKS, *SATELLITES] if x.source == "ticket_legs" and x.name in (tables or TABLES)]
    if "ticket_legs" in src and "ticket_legs" not in t and len(wanted) > 1:
        legs = src["ticket_legs"]
        if load_ts is not None and all(all_new(n) for n in wanted):
            # one spread for both tables; the link takes the first row of each of its keys
            keys = list(LINK_BY_NAME["link_ticket_flight"].key_cols)
            legs = legs.withColumn("_first", F.row_number().over(Window.partitionBy(*keys).orderBy("ticket_no")) == 1)
            legs = batch.aligned(legs, bucket_key("link_ticket_flight"), parts)
        legs = legs.persist()
        src = LazyTables({n: (lambda n=n, src=src: legs if n == "ticket_legs" else src[n]) for n in src if n != "ticket_leg_keys"})

    def spread(name: str) -> Spread:
        if all_new(name):
            return (lambda rows, key: batch.aligned(rows, key, parts)) if name in LEG_TABLES else batch.spread
        return batch.mark if name in LEG_TABLES else _as_is
    made = build_vault(src, load_ts, tables, spread, LEG_TABLES)

    def write(item: tuple[str, DataFrame]) -> tuple[str, DataFrame]:
        name, rows = item
        past = near(batch, name, rows)
        if past is not None:
            past = past.drop("writer", "batch_id")
        if name in HUB_BY_NAME or name in LINK_BY_NAME:
            key = HUB_BY_NAME[name].hash_col if name in HUB_BY_NAME else LINK_BY_NAME[name].hash_col
            if past is not None:
                rows = insert_if_absent(stored_for_batch(past, rows, [key]), rows, [key], unique=True)
        else:
            sat = next(s for s in SATELLITES if s.name == name)
            past = stored_for_batch(past, rows, [parent_id(sat)]) if past is not None else None
            rows = new_satellite_rows(sat, rows, past, on_unchanged)
        batch.write(name, packed(name, rows), spread=all_new(name))
        return name, rows.drop("bucket", *(LINK_BY_NAME["link_ticket_flight"].key_cols if name in LEG_TABLES else []))
    try:
        with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
            return dict(pool.map(write, list(made.items())))
    finally:
        if legs is not None:
            legs.unpersist()


def load_vault(spark: SparkSession, t: dict[str, DataFrame], root: str, batch_id: int, load_ts,
               on_unchanged: str = "append", tables: list[str] | None = None,
               writer: str = "batch", buckets: int = commits.BUCKETS) -> dict[str, DataFrame]:
    """Load one batch of booking-model rows (or change images) into the stored history layer; all its tables
    appear at once. Batch ids count per writer; of two loads at the same time one fails and is to be repeated."""
    batch = begin_batch(spark, root, writer, batch_id, buckets)
    written = write_batch(batch, t, load_ts, on_unchanged, tables)
    batch.commit()
    return written
