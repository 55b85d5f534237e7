"""Tables that are loaded together: batches that appear at once, bucketed by key, compacted.

Below `root`, every batch writes its rows of a table to `<table>/run=<run>/bucket=<b>`;
the run's name is new for each attempt. What readers see is the newest manifest,
`_manifest/<version>.json`: the committed runs, which buckets each has of which table,
and the tables' schemas. A batch commits all its tables by one manifest, put in place by
a rename that fails if that version exists; until then nothing of it is seen, and what
a failed attempt left is in no manifest. If another load committed meanwhile, the commit
fails (`ConcurrentLoad`) and the batch is to be loaded again.

A row's bucket comes from its table's key (`bucket_of`), or from a column `bucket` that the
caller computed from a key the table does not store. It is the hash by which Spark partitions
a shuffle: rows that are partitioned by that key for a join lie in few buckets a task and are
written as they are (`Batch.aligned`). A batch asks for the buckets of its
own keys only (`Batch.near`); files of other buckets are neither listed nor read. The
number of buckets is fixed when the first batch is committed.

Rows are written sorted by key inside a bucket. `compact` merges runs of one level as one of
the next level and commits that like a batch: with a fan of f, a row is rewritten
log_f(batches) times. A table that only one of the merged runs holds is in the order of a
merged run already: its files are taken over as they are. The newest batch of each writer
stays as it is, so that it can be repeated.
`vacuum` removes files that no kept manifest names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sinks import _fs

COMPRESSION = "zstd"  # of stored rows: hex digests take half the room that they take without entropy coding
BUCKETS = 16  # of a new set of tables; a large history wants about its size / 1 GB


class ConcurrentLoad(RuntimeError):
    """Another load committed since this batch began."""


@dataclass(frozen=True)
class Run:
    """One committed batch (or compaction): its rows carry writer and batch_id themselves."""
    run: str
    writer: str
    batch_id: int
    tables: dict                # table -> buckets it has rows in
    level: int = 0              # how often its rows were merged
    order: dict = field(default_factory=dict)     # table -> columns its rows are sorted by inside a bucket
    folders: dict = field(default_factory=dict)   # table -> run that wrote its files, where another one did

    def folder(self, table: str) -> str:
        return f"run={self.folders.get(table, self.run)}"


@dataclass(frozen=True)
class Manifest:
    version: int = -1
    buckets: int = BUCKETS
    runs: tuple = ()
    schemas: dict = field(default_factory=dict)   # table -> schema as JSON
    merged: dict = field(default_factory=dict)    # writer -> newest batch inside a compacted run


# --- manifest files ------------------------------------------------------------------------
def _folder(root: str) -> str:
    return f"{root.rstrip('/')}/_manifest"


def _versions(spark: SparkSession, root: str) -> list[int]:
    fs, p = _fs(spark, _folder(root))
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read_manifest(spark: SparkSession, root: str) -> Manifest:
    """The newest committed state (an empty one where nothing was committed)."""
    found = _versions(spark, root)
    if not found:
        return Manifest()
    fs, p = _fs(spark, f"{_folder(root)}/{found[-1]}.json")
    stream = fs.open(p)
    try:
        d = json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()
    return Manifest(d["version"], d["buckets"], tuple(Run(**r) for r in d["runs"]), d["schemas"], d["merged"])


def _write_manifest(spark: SparkSession, root: str, m: Manifest) -> None:
    jvm = spark.sparkContext._jvm
    fs, tmp = _fs(spark, f"{_folder(root)}/.{m.version}-{uuid.uuid4().hex}")
    out = fs.create(tmp, False)
    try:
        out.write(bytearray(json.dumps({**asdict(m), "runs": [asdict(r) for r in m.runs]}).encode()))
    finally:
        out.close()
    target = jvm.org.apache.hadoop.fs.Path(f"{_folder(root)}/{m.version}.json")
    # a FileContext's rename fails if the target exists; a file system's may overwrite it
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(tmp), fs.makeQualified(target), options)
    except Exception as e:
        fs.delete(tmp, False)
        if fs.exists(target):
            raise ConcurrentLoad(f"version {m.version} of {root} was committed by another load") from e
        raise


# --- reading ----------------------------------------------------------------------------------
def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.hash(key), F.lit(buckets)).cast("int")


def bucket_of(key: str, buckets: int) -> Column:
    return _bucket(F.col(key), buckets)


def read_runs(spark: SparkSession, root: str, m: Manifest, table: str, only: set[int] | None = None) -> DataFrame | None:
    """Rows of a table in the manifest's runs (of some buckets only), or None without any."""
    base = f"{root.rstrip('/')}/{table}"
    paths = []
    for r in m.runs:
        has = r.tables.get(table, [])
        if only is None:
            paths += [f"{base}/{r.folder(table)}"] if has else []
        else:
            paths += [f"{base}/{r.folder(table)}/bucket={b}" for b in has if b in only]
    if table not in m.schemas or not any(table in r.tables for r in m.runs):
        return None
    schema = T.StructType.fromJson(json.loads(m.schemas[table]))
    if not paths:
        return spark.createDataFrame([], schema)
    full = T.StructType([*schema.fields, T.StructField("run", T.StringType()), T.StructField("bucket", T.IntegerType())])
    return spark.read.schema(full).option("basePath", base).parquet(*paths)


def tables_of(spark: SparkSession, root: str) -> list[str]:
    return sorted({t for r in read_manifest(spark, root).runs for t in r.tables})


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """Committed rows of a table with the writer and batch_id that stored them."""
    df = read_runs(spark, root, read_manifest(spark, root), table)
    return None if df is None else df.drop("run", "bucket")


# --- writing ----------------------------------------------------------------------------------
class Batch:
    """One batch of a writer: what was committed before it, and what it adds.

    A batch that its writer committed already is replaced by this one (its rows and those
    of the writer's later batches are not seen while it loads); one that is part of a
    compacted run cannot be.
    """

    def __init__(self, spark: SparkSession, root: str, writer: str, batch_id: int, keys: dict[str, str], buckets: int = BUCKETS,
                 order: dict[str, Sequence[str]] | None = None):
        self.spark, self.root, self.writer, self.batch_id, self.keys = spark, root.rstrip("/"), writer, batch_id, keys
        self.order = order or {}
        m = read_manifest(spark, root)
        if 0 <= batch_id <= m.merged.get(writer, -1):
            raise ValueError(f"batch {batch_id} of {writer} is part of a compacted run of {root}")
        if m.version < 0:
            m = replace(m, buckets=buckets)
        self.base = replace(m, runs=tuple(r for r in m.runs if r.writer != writer or r.batch_id < batch_id))
        self.run = f"{uuid.uuid4().hex}"
        self.tables: dict[str, list[int]] = {}
        self.schemas = dict(m.schemas)

    def read(self, table: str, only: set[int] | None = None) -> DataFrame | None:
        df = read_runs(self.spark, self.root, self.base, table, only)
        return None if df is None else df.drop("run", "bucket")

    def near(self, table: str, rows: DataFrame, column: str | None = None) -> DataFrame | None:
        """Committed rows in the buckets of the keys of `rows` (`column` there, if it has another name).
        The bucket numbers, at most as many as there are buckets, go through the driver."""
        if not self.holds(table):
            return None
        known = "bucket" in rows.columns
        wanted = rows.select((F.col("bucket") if known else bucket_of(column or self.keys[table], self.base.buckets)).alias("b")).distinct().collect()
        return self.read(table, {r["b"] for r in wanted})

    def holds(self, table: str) -> bool:
        """Whether an earlier batch committed rows of the table."""
        return any(table in r.tables for r in self.base.runs)

    def mark(self, rows: DataFrame, key: Column) -> DataFrame:
        """Rows with the bucket of `key`."""
        return rows.withColumn("bucket", _bucket(key, self.base.buckets))

    def spread(self, rows: DataFrame, key: Column) -> DataFrame:
        """Rows brought together by the bucket of `key`, a large bucket in several tasks."""
        return self.mark(rows, key).hint("rebalance", "bucket")

    def aligned(self, rows: DataFrame, key: Column, partitions: int | None = None) -> DataFrame:
        """`spread` for rows that come from a join or grouping by the column `key`: Spark leaves the repartition out where
        they are partitioned by it already, in that many `partitions` (the session's number, if it is not given). Of n
        shuffle partitions each holds buckets / gcd(n, buckets) buckets."""
        return self.mark(rows.repartition(partitions, key) if partitions else rows.repartition(key), key)

    def sorted_by(self, table: str) -> list[str]:
        """Columns by which rows of a table are sorted inside a bucket (default: the key, if the table stores it)."""
        return list(self.order.get(table, [self.keys[table]]))

    def write(self, table: str, rows: DataFrame, spread: bool = False) -> None:
        """Add rows of a table; its rows come together by bucket, a large bucket in several files. `spread=True`
        says that they are so already: a table whose columns are digests is spread by `spread` before they are made."""
        own = [f for f in rows.schema.fields if f.name != "bucket"]
        schema = T.StructType([*own, T.StructField("writer", T.StringType()), T.StructField("batch_id", T.LongType())])
        # equal in all rows: added behind the shuffle
        self._write(table, rows, schema, {"writer": F.lit(self.writer), "batch_id": F.lit(self.batch_id).cast("long")}, spread)

    def _write(self, table: str, rows: DataFrame, schema: T.StructType, stamp: dict[str, Column], spread: bool = False) -> None:
        names = schema.names
        if table in self.schemas:
            known = T.StructType.fromJson(json.loads(self.schemas[table]))
            if {f.name: f.dataType for f in known} != {f.name: f.dataType for f in schema}:
                raise ValueError(f"{table} has other columns than before: {schema.simpleString()}")
            names = known.names
        else:
            self.schemas[table] = schema.json()
        path = f"{self.root}/{table}/run={self.run}"
        out = rows if "bucket" in rows.columns else rows.withColumn("bucket", bucket_of(self.keys[table], self.base.buckets))
        if not spread:
            out = out.hint("rebalance", "bucket")
        out = out.withColumns(stamp).select(*names, "bucket").sortWithinPartitions("bucket", *self.sorted_by(table))
        out.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", COMPRESSION).partitionBy("bucket").parquet(path)
        fs, p = _fs(self.spark, path)
        names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
        self.tables[table] = sorted(int(n[7:]) for n in names if n.startswith("bucket="))

    def commit(self) -> Manifest:
        """Show everything the batch wrote, at once."""
        run = Run(self.run, self.writer, self.batch_id, {t: b for t, b in self.tables.items() if b}, order=self._orders(self.tables))
        return self._commit(replace(self.base, runs=(*self.base.runs, run)))

    def _orders(self, tables) -> dict[str, list[str]]:
        return {t: self.sorted_by(t) for t in tables}

    def _commit(self, m: Manifest) -> Manifest:
        m = replace(m, version=m.version + 1, schemas=self.schemas)
        _write_manifest(self.spark, self.root, m)
        return m


def compact(spark: SparkSession, root: str, keys: dict[str, str], fan: int = 8, order: dict[str, Sequence[str]] | None = None,
            reduce: Callable[[str, dict[str, DataFrame]], DataFrame] | None = None) -> Manifest:
    """Merge the runs of every level that has `fan` or more (the newest batch of each writer left out).

    Rows are sorted inside their bucket by `order[table]` (default: the key), so a look-up skips
    row groups. `reduce(table, merged rows by table)` may leave rows out that others of the
    merged runs make void (or give a table back as it is).
    """
    m = read_manifest(spark, root)
    newest = {}
    for r in m.runs:
        newest[r.writer] = max(newest.get(r.writer, r.batch_id), r.batch_id)
    level = 0
    while any(r.level >= level for r in m.runs):
        old = tuple(r for r in m.runs if r.level == level and (level or r.batch_id < newest[r.writer]))
        if len(old) >= max(fan, 2):
            m = _merge(spark, root, m, old, keys, order or {}, reduce)
        level += 1
    return m


def _merge(spark: SparkSession, root: str, m: Manifest, old: tuple, keys: dict[str, str], order: dict, reduce) -> Manifest:
    batch = Batch(spark, root, f"_merged-{uuid.uuid4().hex[:8]}", -1, keys, order=order)
    batch.base = m
    rows = {t: read_runs(spark, root, replace(m, runs=old), t).drop("run") for t in sorted({t for r in old for t in r.tables})}
    folders = {}
    for table in rows:
        left = reduce(table, rows) if reduce else rows[table]
        holders = [r for r in old if r.tables.get(table)]
        if len(holders) == 1 and left is rows[table] and holders[0].order.get(table) == batch.sorted_by(table):
            folders[table], batch.tables[table] = holders[0].folder(table)[4:], holders[0].tables[table]
            continue
        schema = T.StructType.fromJson(json.loads(m.schemas[table]))
        batch._write(table, left.select(*schema.names, "bucket"), schema, {})
    done = dict(m.merged)
    for r in old:
        if r.batch_id >= 0:
            done[r.writer] = max(done.get(r.writer, -1), r.batch_id)
    run = Run(batch.run, batch.writer, -1, {t: b for t, b in batch.tables.items() if b}, old[0].level + 1, batch._orders(batch.tables), folders)
    return batch._commit(replace(m, runs=(run, *[r for r in m.runs if r not in old]), merged=done))


def vacuum(spark: SparkSession, root: str, keep_versions: int = 1) -> int:
    """Delete runs that none of the last `keep_versions` manifests names, and older manifests; the number of
    deleted folders. Only while no load and no reader of an older state is at work."""
    found = _versions(spark, root)
    keep = set()
    for v in found[-keep_versions:]:
        fs, p = _fs(spark, f"{_folder(root)}/{v}.json")
        stream = fs.open(p)
        for r in json.loads(bytes(stream.readAllBytes()).decode())["runs"]:
            keep |= {r["run"], *((t, run) for t, run in r.get("folders", {}).items())}
        stream.close()
    fs, base = _fs(spark, root)
    gone = 0
    found_runs = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/*/run=*")) or []
    for s in found_runs:
        run = s.getPath().getName()[4:]
        if run not in keep and (s.getPath().getParent().getName(), run) not in keep:
            gone += bool(fs.delete(s.getPath(), True))
    for v in found[:-keep_versions]:
        fs.delete(_fs(spark, f"{_folder(root)}/{v}.json")[1], False)
    return gone
