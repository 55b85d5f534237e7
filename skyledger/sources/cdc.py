"""Change-data-capture input: sources, envelope parsing, quarantine, snapshot diff.

A change message is `{"payload": {"op": ..., "before": {...}, "after": {...}}}`
on topic `<prefix>.<table>`. `parse_changes` keeps the accepted operations
(c, u, d; r optionally), picks the row image (`after`, or `before` for a
delete) and leaves it as JSON text, to be typed per table by `images`.
Malformed messages and messages without a payload go to `quarantine`; null
values (tombstones) are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import hash_columns
from ..schemas import OLTP, PRIMARY_KEYS

TOPIC_PREFIX = "airline.public"
ACCEPTED_OPS = ("c", "u", "d")
_BAD = "_unreadable"

ENVELOPE = T.StructType([T.StructField("payload", T.StructType([
    T.StructField("op", T.StringType()),
    # images stay raw JSON text here; they are typed per table afterwards
    T.StructField("before", T.StringType()),
    T.StructField("after", T.StringType()),
    T.StructField("ts_ms", T.LongType()),
])), T.StructField("_malformed", T.StringType())])

# Kafka-like columns every source is brought to.
FEED_COLUMNS = ["topic", "partition", "offset", "timestamp", "key", "value"]
# the place of a message, by which a repeated delivery is known
MESSAGE_KEY = ["topic", "partition", "offset"]


def topic_of(table: str, prefix: str = TOPIC_PREFIX) -> str:
    return f"{prefix}.{table}"


# --- sources -------------------------------------------------------------------------
def cdc_source(spark: SparkSession, kind: str = "kafka", path: str | None = None, topics: Sequence[str] = (),
               options: dict | None = None, stream: bool = True) -> DataFrame:
    """Change messages as (topic, partition, offset, timestamp, key, value).

    kind="kafka": subscribe to `topics` from the earliest offset (needs the
    Kafka connector on the cluster). kind="json", "parquet", ...: files of feed rows
    with the columns above in one of Spark's formats.
    """
    opts = dict(options or {})
    if kind == "kafka":
        r = spark.readStream if stream else spark.read
        r = r.format("kafka").option("subscribe", ",".join(topics)).option("startingOffsets", "earliest")
        for k, v in opts.items():
            r = r.option(k, v)
        df = r.load()
        return df.select("topic", "partition", "offset", "timestamp",
                         F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
    schema = T.StructType([T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
                           T.StructField("offset", T.LongType()), T.StructField("timestamp", T.TimestampType()),
                           T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])
    r = (spark.readStream if stream else spark.read).schema(schema)
    for k, v in opts.items():
        r = r.option(k, v)
    df = r.format(kind).load(path)
    return df.where(F.col("topic").isin(*topics)) if topics else df


# --- parsing ---------------------------------------------------------------------------
def _envelope(value: Column) -> Column:
    return F.from_json(value, ENVELOPE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"})


def _reject_reason(value_is_null: Column, env: Column) -> Column:
    return (F.when(value_is_null, F.lit("tombstone"))
            .when(env.isNull() | env["_malformed"].isNotNull(), F.lit("malformed"))
            .when(env["payload"].isNull(), F.lit("no_payload")))


def parse_envelopes(feed: DataFrame) -> DataFrame:
    """Adds `env` (parsed envelope) and `reject_reason` (NULL for parseable
    messages with a payload)."""
    df = feed.withColumn("env", _envelope(F.col("value")))
    return df.withColumn("reject_reason", _reject_reason(F.col("value").isNull(), F.col("env")))


def redelivered_places(feed: DataFrame) -> DataFrame:
    """Places of messages that occur more than once."""
    return feed.groupBy(*MESSAGE_KEY).count().where("count > 1").select(*MESSAGE_KEY)


def has_redelivered(feed: DataFrame) -> bool:
    """Whether a message occurs more than once. 64 neighbouring offsets are one row: how many messages they have, and
    which of them have one (a bit each). A topic's messages lie together, so a task sends few such rows."""
    words = (feed.where(F.col("topic").isNotNull() & F.col("partition").isNotNull() & F.col("offset").isNotNull())
             .groupBy("topic", "partition", F.shiftright("offset", 6).alias("_word"))
             .agg(F.count(F.lit(1)).alias("_n"), F.expr("bit_or(shiftleft(1L, CAST(offset & 63 AS INT)))").alias("_bits")))
    return not words.where(F.col("_n") > F.bit_count("_bits")).isEmpty()


def drop_redelivered(feed: DataFrame) -> DataFrame:
    """One row per message. Which places occur again is found from the places alone (a hash
    aggregate); only the messages of those, few in any healthy feed, are sorted to keep one of
    each. A message without a place cannot be told from another and stays."""
    again = redelivered_places(feed)
    once = feed.join(again, MESSAGE_KEY, "left_anti")
    return once.unionByName(feed.join(again, MESSAGE_KEY, "left_semi").dropDuplicates(MESSAGE_KEY))


def watch_redelivery(feed: DataFrame, window: str) -> DataFrame:
    """A streaming feed without messages that were delivered within `window` before, by Spark's state store.

    Time is that of arrival: topics lag behind each other, and by message time the watermark
    of one would drop another's messages as late. What is delivered again after the window is
    found when it is loaded (equal parent, load time and hash)."""
    arrived = feed.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", window)
    return arrived.dropDuplicatesWithinWatermark(MESSAGE_KEY).drop("_arrived")


def parse_changes(feed: DataFrame, include_snapshot: bool = False, ops: Sequence[str] = ACCEPTED_OPS, once: bool = False) -> DataFrame:
    """Accepted change rows: topic, partition, offset, timestamp, op, data (JSON image).

    Duplicate deliveries of one message (same topic/partition/offset) are kept
    once (`once=True` says that there are none); a message with no usable image is skipped, as the reference does.
    Each value is parsed once, by a generator of one row: a filter written directly
    over `from_json` would be pushed below it and parse the message once per reference.
    """
    accepted = list(ops) + (["r"] if include_snapshot else [])
    keys = MESSAGE_KEY
    rows = feed.select(*keys, "timestamp", "value")
    parsed = ((rows if once else drop_redelivered(rows))
              .select(*keys, "timestamp", F.col("value").isNull().alias("_tomb"),
                      F.explode(F.array(_envelope(F.col("value")))).alias("env")))
    op = F.col("env.payload.op")
    data = F.when(op != "d", F.col("env.payload.after")).otherwise(F.col("env.payload.before"))
    out = (parsed.where(_reject_reason(F.col("_tomb"), F.col("env")).isNull())
           .select(*keys, "timestamp", op.alias("op"), data.alias("data")))
    # an empty image says nothing and is skipped
    return out.where(F.col("op").isin(*accepted) & F.col("data").isNotNull() & (F.col("data") != "null")
                     & ~F.col("data").rlike(r"^\s*\{\s*\}\s*$"))


def quarantine(feed: DataFrame) -> DataFrame:
    """Messages that cannot be processed (not JSON, no payload), with the reason.
    Tombstones are not errors and are not kept."""
    return (parse_envelopes(feed).where(F.col("reject_reason").isin("malformed", "no_payload"))
            .select(*FEED_COLUMNS, "reject_reason"))


DECIMAL_ENCODINGS = ("auto", "text", "base64")


def encode_decimal(c: Column, scale: int = 2) -> Column:
    """The base64 form of a NUMERIC value: its unscaled integer as 8 big-endian bytes."""
    unscaled = (c * F.lit(10 ** scale)).cast("long")
    return F.base64(F.unhex(F.lpad(F.hex(unscaled), 16, "0")))


def decode_decimal(c: Column, scale: int = 2, precision: int = 10, encoding: str = "auto") -> Column:
    """NUMERIC value from a change image, by the connector's setting: "text" (plain
    number or numeric text) or "base64" (big-endian unscaled integer, its default).
    "auto" takes what reads as a number for one; a base64 text may be all digits
    (some negative values), so name the encoding where it is known. What does not
    read in the encoding is NULL."""
    if encoding not in DECIMAL_ENCODINGS:
        raise ValueError(f"encoding must be one of {DECIMAL_ENCODINGS}")
    as_text = F.when(c.rlike(r"^-?[0-9]+(\.[0-9]+)?([eE][-+]?[0-9]+)?$"), c)
    if encoding == "text":
        return as_text.cast(f"decimal({precision},{scale})")
    if encoding == "base64":
        c = F.when(F.try_to_binary(c, F.lit("base64")).isNotNull(), c)
    raw = F.unbase64(c)
    hexs = F.hex(raw)
    unsigned = F.conv(hexs, 16, 10).cast("decimal(38,0)")
    negative = F.substring(hexs, 1, 1).isin("8", "9", "A", "B", "C", "D", "E", "F")
    # two's complement in whole numbers: -(inverted bits + 1)
    inverted = F.conv(F.translate(hexs, "0123456789ABCDEF", "FEDCBA9876543210"), 16, 10).cast("decimal(38,0)")
    signed = F.when(negative, -(inverted + F.lit(1))).otherwise(unsigned)
    from_b64 = (signed / F.lit(10 ** scale)).cast(f"decimal({precision},{scale})")
    if encoding == "base64":
        return from_b64
    return F.coalesce(as_text.cast(f"decimal({precision},{scale})"), from_b64)


def _typed(changes: DataFrame, table: str, schema: T.StructType | None, prefix: str, decimals: str = "auto") -> DataFrame:
    """Changes of one table with the typed image `i` and `problem`: what is wrong with it, else NULL."""
    schema = schema or _image_schema(table)
    text = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    i = F.col("i")
    required = [f.name for f in OLTP[table].fields if f.name in schema.names and (not f.nullable or f.name in PRIMARY_KEYS[table])]
    keys = [c for c in required if c in PRIMARY_KEYS[table]]

    def lacks(names):
        out = F.lit(False)
        for n in names:
            out = out | i[n].isNull()
        return out

    # a number that does not read as one
    unread = F.lit(False)
    for f in OLTP[table].fields:
        if isinstance(f.dataType, T.DecimalType) and f.name in schema.names:
            unread = unread | (i[f.name].isNotNull() & decode_decimal(i[f.name], f.dataType.scale, f.dataType.precision, decimals).isNull())
    problem = (F.when(i.isNull() | i[_BAD].isNotNull() | unread, F.lit("bad_image"))
               .when(F.when(F.col("op") == "d", lacks(keys)).otherwise(lacks(required)), F.lit("missing_value")))
    rows = changes.where(F.col("topic") == topic_of(table, prefix))
    img = F.from_json(F.col("data"), text, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})
    # parsed once, by a generator of one row (see `parse_changes`)
    return rows.withColumn("i", F.explode(F.array(img))).withColumn("problem", problem)


def images(changes: DataFrame, table: str, schema: T.StructType | None = None,
           prefix: str = TOPIC_PREFIX, decimals: str = "auto") -> DataFrame:
    """Typed row images of one table's topic, with the change metadata kept
    as `_op`, `_partition`, `_offset`, `_load_ts` (message time). Images that do
    not fit the table's types and NOT NULLs are left out (see `image_rejects`)."""
    names = (schema or _image_schema(table)).names
    rows = _typed(changes, table, schema, prefix, decimals).where(F.col("problem").isNull())
    return rows.select(*[F.col("i")[n].alias(n) for n in names], F.col("op").alias("_op"), F.col("partition").alias("_partition"),
                       F.col("offset").alias("_offset"), F.col("timestamp").alias("_load_ts"))


def image_rejects(changes: DataFrame, tables: Sequence[str], prefix: str = TOPIC_PREFIX,
                  decimals: str = "auto") -> DataFrame:
    """Accepted changes whose image cannot be stored, as quarantine rows."""
    out = None
    for t in tables:
        bad = _typed(changes, t, None, prefix, decimals).where(F.col("problem").isNotNull()).select(
            "topic", "partition", "offset", "timestamp", F.lit(None).cast("string").alias("key"), F.col("data").alias("value"),
            F.col("problem").alias("reject_reason"))
        out = bad if out is None else out.unionByName(bad)
    return out


def _image_schema(table: str) -> T.StructType:
    # images carry NUMERIC as text/base64 and JSONB as text: read those as strings
    fields = []
    for f in OLTP[table].fields:
        t = T.StringType() if isinstance(f.dataType, T.DecimalType) else f.dataType
        fields.append(T.StructField(f.name, t, True))
    return T.StructType(fields)


def typed_images(changes: DataFrame, table: str, prefix: str = TOPIC_PREFIX, decimals: str = "auto") -> DataFrame:
    """`images` with NUMERIC columns decoded to their declared decimal type."""
    df = images(changes, table, prefix=prefix, decimals=decimals)
    for f in OLTP[table].fields:
        if isinstance(f.dataType, T.DecimalType):
            df = df.withColumn(f.name, decode_decimal(F.col(f.name), f.dataType.scale, f.dataType.precision, decimals))
    return df


# --- snapshot diff ----------------------------------------------------------------------------
def snapshot_diff(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Change feed between two snapshots of one table.

    op = 'c' (key only in new), 'd' (only in old), 'u' (in both, any value
    differs); unchanged rows produce nothing. Columns: op, key columns,
    `before` and `after` structs of the full rows. One full outer join on the
    key; rows are compared by a record hash so wide rows stay cheap.
    """
    key = list(key)
    cols = [c for c in old.columns]
    o = old.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)],
                   F.struct(*cols).alias("before"), hash_columns(old, cols).alias("_ho"))
    n = new.select(*[F.col(k).alias(f"_j{i}") for i, k in enumerate(key)],
                   F.struct(*[F.col(c) for c in cols]).alias("after"), hash_columns(new, cols).alias("_hn"))
    cond = None
    for i in range(len(key)):
        e = F.col(f"_k{i}") == F.col(f"_j{i}")
        cond = e if cond is None else cond & e
    j = o.join(n, cond, "full")
    op = (F.when(F.col("_ho").isNull(), F.lit("c"))
          .when(F.col("_hn").isNull(), F.lit("d"))
          .when(F.col("_ho") != F.col("_hn"), F.lit("u")))
    return (j.withColumn("op", op).where(F.col("op").isNotNull())
            .select("op", *[F.coalesce(F.col(f"_k{i}"), F.col(f"_j{i}")).alias(k) for i, k in enumerate(key)],
                    "before", "after"))


def apply_changes(old: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """Inverse of `snapshot_diff`: old snapshot + change feed -> new snapshot."""
    key = list(key)
    touched = changes.select(*key)
    kept = old.join(touched, key, "left_anti")
    upserts = changes.where(F.col("op").isin("c", "u", "r")).select("after.*")
    return kept.unionByName(upserts.select(*old.columns))


def to_envelopes(changes: DataFrame, table: str, prefix: str = TOPIC_PREFIX) -> DataFrame:
    """Change rows (op, before, after) as feed rows with JSON envelopes."""
    env = F.to_json(F.struct(F.struct(F.col("op"), F.col("before"), F.col("after")).alias("payload")))
    return changes.select(F.lit(topic_of(table, prefix)).alias("topic"), F.lit(0).alias("partition"),
                          F.monotonically_increasing_id().alias("offset"),
                          F.current_timestamp().alias("timestamp"),
                          F.lit(None).cast("string").alias("key"), env.alias("value"))
