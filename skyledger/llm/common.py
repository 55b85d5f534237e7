"""Shared helpers of the text operators: vectorised word splitting and hashing
over Arrow string buffers, scratch tables, unique row keys, connected components.

Words are maximal runs of bytes outside 0x20 and 0x09-0x0D (the contract's
`[^\\x20\\x09-\\x0D]+`: those six bytes never occur inside a multi-byte UTF-8
character, so bytes and characters give the same words).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

CHUNK_BYTES = 1 << 19  # text handled at once by the vectorised helpers (a longer single text is one chunk)

_rng = np.random.default_rng(20240531)
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_MULT = np.uint64(0x9E3779B97F4A7C15)  # odd, hence invertible modulo 2**64
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_POW = {"n": 0, "p": None, "q": None}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, grown on demand."""
    if _POW["n"] < n:
        n = max(n, CHUNK_BYTES + 1024)
        _POW["p"] = np.concatenate(([np.uint64(1)], np.cumprod(np.full(n - 1, _MULT, dtype=np.uint64))))
        _POW["q"] = np.concatenate(([np.uint64(1)], np.cumprod(np.full(n - 1, _INV, dtype=np.uint64))))
        _POW["n"] = n
    return _POW["p"], _POW["q"]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_buffers(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col, "").cast(pa.large_string())
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    buf = col.buffers()[2]
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None else np.zeros(0, np.uint8)
    if len(off) == 0:
        off = np.zeros(1, np.int64)
    return data[off[0]:off[-1]], off - off[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of at most `limit` bytes (one row at least)."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = max(a + 1, min(b, n))
        yield a, b
        a = b


class Words:
    """Words of the rows [a, b): start/end byte, row number and 64-bit hash of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE):
        self.data, self.offsets = data, offsets
        inside = ~separators[data]
        st, en = inside.copy(), inside.copy()
        if len(data):
            st[1:] &= ~inside[:-1]
            en[:-1] &= ~inside[1:]
            full = offsets[1:] > offsets[:-1]
            first, last = offsets[:-1][full], offsets[1:][full] - 1
            st[first] = inside[first]
            en[last] = inside[last]
        self.start = np.flatnonzero(st)
        self.end = np.flatnonzero(en) + 1
        self.first = np.searchsorted(self.start, offsets)  # number of the first word of each row
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(len(offsets) - 1), self.count)

    def hashes(self) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, np.uint64)
        return run_hashes(self.data, self.start, self.end)


def run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs [start, end)."""
    p, q = powers(len(data) + 1)
    c = np.empty(len(data) + 1, dtype=np.uint64)
    c[0] = 0
    np.cumsum(BYTE_CODE[data] * p[:len(data)], out=c[1:])
    h = (c[end] - c[start]) * q[start]
    return mix(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def window_hashes(h: np.ndarray, row: np.ndarray, k: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Start positions and hashes of all runs of k consecutive words inside one row."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    p, q = powers(len(h) + 1)
    c = np.empty(len(h) + 1, dtype=np.uint64)
    c[0] = 0
    np.cumsum(mix(h + np.uint64(salt)) * p[:len(h)], out=c[1:])
    w = mix((c[k:] - c[:-k]) * q[:n] + np.uint64(k))
    at = np.flatnonzero(row[k - 1:] == row[:n])
    return at, w[at]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated aranges: starts[i], starts[i]+1, ... for each i."""
    lengths = lengths.astype(np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    out = np.ones(total, dtype=np.int64)
    full = lengths > 0
    heads = (ends - lengths)[full]
    s, ln = starts[full].astype(np.int64), lengths[full]
    out[heads[0]] = s[0]
    out[heads[1:]] = s[1:] - (s[:-1] + ln[:-1] - 1)
    return np.cumsum(out)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder of the cluster (spark.checkpoint.dir)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a DataFrame to the shared folder and read it back: cuts the lineage
    with files that survive lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def workers_see_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (local
    runs started elsewhere; a cluster has the package installed)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shielded(docs: DataFrame, work: Callable[..., DataFrame], *cols: str) -> DataFrame:
    """`work(docs, *cols)` over columns with names that no operator uses (by position, so any name is safe);
    what comes back has the same columns, under their own names again."""
    inner = [f"x{i}" for i in range(len(docs.columns))]
    return work(docs.toDF(*inner), *[inner[docs.columns.index(c)] for c in cols]).toDF(*docs.columns)


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame | None]:
    """(rows `_k` long, `_text`; key table or None).

    `_k` is unique per row. Normally it is the id itself. If an id is null or
    repeats, rows are numbered instead (in a written copy, so that the numbers
    stay fixed) and the key table maps `_k` back to the id.
    """
    ids = docs.groupBy(F.col(id_col).alias("_i")).agg(F.count(F.lit(1)).alias("_n"))
    if not ids.where("_n > 1 or _i is null").limit(1).count():
        return docs.select(F.col(id_col).cast("long").alias("_k"), F.col(text_col).cast("string").alias("_text")), None
    numbered = stored(docs.select(F.monotonically_increasing_id().alias("_k"), F.col(id_col).cast("long").alias("_id"),
                                  F.col(text_col).cast("string").alias("_text")), "numbered")
    return numbered.select("_k", "_text"), numbered.select("_k", "_id")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component = smallest node of its component) for undirected links.

    Alternating large-star / small-star steps: each step is a grouped minimum and
    a join on the node, so no group is gathered and nothing reaches the driver
    but one count per round. Each round is written to the shared folder.
    """
    spark = edges.sparkSession
    e = stored(edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
               .where("u is not null and v is not null and u <> v").distinct(), "edges")
    last = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: every larger neighbour of u is linked to the smallest node seen from u
        large = (both.where("v > u").join(low, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: u and its smaller neighbours are linked to their smallest
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        e = stored(small, "edges")
        # stable once every node hangs on one root that is itself no child
        s = e.agg(F.count(F.lit(1)).alias("n"), F.sum("v").cast("decimal(38,0)").alias("s"),
                  F.sum("u").cast("decimal(38,0)").alias("t")).first()
        now = (s["n"], s["s"], s["t"])
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("connected components did not settle")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
