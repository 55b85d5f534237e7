"""Sinks: insert-if-absent, keyed upsert, partition replacement, publish.

Parquet has no transactions, so every publishing sink follows one pattern:
materialise the new rows once into the shared checkpoint folder (lineage is
cut, a lost executor cannot make the checks and the write see different
data), run the checks on that copy, and only then write. A failed check
leaves the target untouched.

Keyed upsert never overwrites the directory it reads: each write goes to a
new `v=<n>` version below the target and readers take the highest version
with a `_SUCCESS` marker.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir, scratch_path

Check = Callable[[DataFrame], object]


# --- pure DataFrame forms ----------------------------------------------------------
def insert_if_absent(target: DataFrame, rows: DataFrame, key: Sequence[str], unique: bool = False, nulls_match: bool = False) -> DataFrame:
    """Rows of `rows` whose key is not yet in `target` (one per key):
    `INSERT ... ON CONFLICT (key) DO NOTHING` as an anti-join. `unique=True`
    says that `rows` has no key twice and saves the aggregate over whole rows.
    `nulls_match=True` takes NULL in a key for a value, as the hash of the key does."""
    key = list(key)
    rows = rows if unique else rows.dropDuplicates(key)
    if not nulls_match:
        return rows.join(target.select(*key), key, "left_anti")
    known = target.select(*[F.col(k).alias(f"_known_{k}") for k in key])
    return rows.join(known, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in key]), "left_anti")


def upsert(target: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """`INSERT ... ON CONFLICT (key) DO UPDATE`: target rows without a new
    version plus all new rows (rows must be unique on key)."""
    key = list(key)
    kept = target.join(rows.select(*key), key, "left_anti").select(*target.columns)
    return kept.unionByName(rows.select(*target.columns))


# --- filesystem helpers (Hadoop FS through the session, works for any scheme) --------
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a batch-partitioned dataset holds a data file (an empty batch leaves none)."""
    fs, _ = _fs(spark, path)
    found = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/writer=*/batch_id=*/part-*"))
    return found is not None and len(found) > 0


def versions(spark: SparkSession, target: str) -> list[int]:
    """Committed versions (`v=<n>` with `_SUCCESS`) of a versioned table, ascending."""
    fs, p = _fs(spark, target)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v="):
            if fs.exists(st.getPath().suffix("/_SUCCESS")):
                out.append(int(name[2:]))
    return sorted(out)


def read_current(spark: SparkSession, target: str) -> DataFrame | None:
    v = versions(spark, target)
    if not v:
        return None
    return spark.read.parquet(f"{target.rstrip('/')}/v={v[-1]}")


def ensure_dataset(spark: SparkSession, path: str, schema: T.StructType, versioned: bool = False,
                   partition_by: Sequence[str] | None = None) -> None:
    """`CREATE TABLE IF NOT EXISTS`: an empty typed dataset when the path is absent."""
    if versioned:
        if versions(spark, path):
            return
        path = f"{path.rstrip('/')}/v=0"
    elif path_exists(spark, path):
        return
    w = spark.createDataFrame([], schema).write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


# --- publishing sinks -------------------------------------------------------------
def materialise(df: DataFrame, eager: bool = True) -> DataFrame:
    """Compute `df` once into the shared checkpoint folder and cut its lineage
    (`eager=False`: with the first job that reads it)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


@contextmanager
def staging(df: DataFrame, name: str):
    """`df` computed once into compressed files of the shared folder, which are deleted at the end: for rows too many
    to keep as plain objects, read back by column."""
    path = scratch_path(df.sparkSession, name)
    try:
        df.write.option("compression", "zstd").parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        fs, p = _fs(df.sparkSession, path)
        fs.delete(p, True)


def publish(df: DataFrame, checks: Sequence[Check], write: Callable[[DataFrame], None]) -> DataFrame:
    """Validate-before-publish: materialise, run every check, then write."""
    staged = materialise(df)
    for chk in checks:
        chk(staged)
    write(staged)
    return staged


def replace_partitions(df: DataFrame, target: str, partition_cols: Sequence[str],
                       checks: Sequence[Check] = (), sort_within: Sequence[str] | None = None) -> DataFrame:
    """`DELETE WHERE day = D; INSERT ...` as a dynamic partition overwrite:
    only the partitions present in `df` are replaced, all others are kept."""
    def write(staged: DataFrame) -> None:
        # a day's rows come together, but a large day is split over several tasks and files
        out = staged.hint("rebalance", *[F.col(c) for c in partition_cols])
        if sort_within:
            out = out.sortWithinPartitions(*sort_within)
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_cols).parquet(target))
    return publish(df, checks, write)


def upsert_table(rows: DataFrame, target: str, key: Sequence[str], checks: Sequence[Check] = (),
                 full: bool = False, sort_within: Sequence[str] | None = None) -> DataFrame:
    """Keyed upsert into a versioned parquet table (or a full replacement).

    New version = old rows whose key is absent from `rows` + `rows`. The new
    version is validated as a whole before it becomes current.
    """
    spark = rows.sparkSession
    key = list(key)
    dup = rows.groupBy(*key).count().where("count > 1").limit(1).count()
    if dup:
        from .quality import DataQualityError
        raise DataQualityError(f"source rows are not unique on {key}")
    cur = None if full else read_current(spark, target)
    new = rows if cur is None else upsert(cur, rows, key)
    nxt = (versions(spark, target) or [-1])[-1] + 1

    def write(staged: DataFrame) -> None:
        out = staged.repartition(*key)
        if sort_within:
            out = out.sortWithinPartitions(*sort_within)
        # not committed yet: what a failed attempt left there is replaced
        out.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{target.rstrip('/')}/v={nxt}")
    return publish(new, checks, write)


def append_batch(df: DataFrame, target: str, batch_id: int, partition_cols: Sequence[str] = (),
                 writer: str = "batch") -> None:
    """Idempotent append: rows of one batch go to `writer=<w>/batch_id=<n>` and a
    replay of the same batch by the same writer overwrites exactly that partition."""
    (df.withColumns({"writer": F.lit(writer), "batch_id": F.lit(batch_id).cast("long")})
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("writer", "batch_id", *partition_cols).parquet(target))
