"""Spark session defaults and shared-storage helpers.

Everything here reads the session first and only fills in values that are
unset, so a cluster's own settings (shuffle partitions, checkpoint dir,
broadcast threshold) always win.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# The one setting results depend on: calendar days are taken in UTC.
REQUIRED_CONF = {"spark.sql.session.timeZone": "UTC"}

# What a session made here starts with; a given session keeps its own.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def build_session(master: str | None = None, app: str = "skyledger",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests (UI off, UTC, AQE on)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {**REQUIRED_CONF, **DEFAULT_CONF}
    conf.update({
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("SKYLEDGER_DRIVER_MEMORY", "8g"),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    })
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if (master or "").startswith("local"):
        # one machine, small files: keep post-shuffle partitions small enough
        # that all local cores get work (a cluster keeps its own sizing)
        conf["spark.sql.adaptive.coalescePartitions.minPartitionSize"] = "64k"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_required_conf(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    """Pin the time zone; all other settings stay the session's own."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (`spark.checkpoint.dir`).

    Only when the session has none (local tests) a scratch folder is created
    and registered, so lineage cuts and published versions always land in
    storage every executor can reach.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: configure a folder all executors share "
                               "(a machine-local temporary folder does not work on a cluster)")
        # unset in a local session (tests): a fresh folder per session
        d = tempfile.mkdtemp(prefix="skyledger-ckpt-", dir=os.environ.get("SKYLEDGER_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory below the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
