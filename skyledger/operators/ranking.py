"""Ranking, mode, share and bucketing operators.

All of them are aggregates or windows over *partitioned* data: none needs
the whole input in one task. The only un-partitioned steps run on tables whose
size is bounded by a parameter (number of range buckets) or by a small key
domain the caller already aggregated to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import percent_half_up


# --- mode with tie-breaks ----------------------------------------------------
def modal_value(df: DataFrame, keys: Sequence[str], value: str, ts: str | None = None,
                out: str | None = None) -> DataFrame:
    """Most frequent `value` per `keys`; ties -> latest `ts`, then lowest value.

    Matches `FIRST_VALUE(v) OVER (PARTITION BY k ORDER BY COUNT(*) DESC,
    MAX(ts) DESC, v)` with PostgreSQL NULL order (DESC puts NULL first, ASC
    last). Two aggregates, both map-side combined, so a key holding a third of
    all rows is reduced per task before it is shuffled.
    """
    keys = list(keys)
    out = out or value
    agg = [F.count(F.lit(1)).alias("_cnt")]
    if ts:
        agg.append(F.max(ts).alias("_last"))
    per_value = df.groupBy(*keys, value).agg(*agg)
    order = [(-F.col("_cnt")).alias("c")]
    if ts:
        # DESC NULLS FIRST on max(ts): NULL sorts before any time
        order.append(F.col("_last").isNotNull().alias("n"))
        order.append((-F.unix_micros(F.col("_last").cast("timestamp"))).alias("t"))
    order.append(F.col(value).isNull().alias("vn"))  # ASC NULLS LAST on the value
    order.append(F.col(value).alias("v"))
    return per_value.groupBy(*keys).agg(F.min_by(F.col(value), F.struct(*order)).alias(out))


# --- percent rank ------------------------------------------------------------
def percent_rank(df: DataFrame, col: str, descending: bool = True, out: str = "percent_rank",
                 buckets: int | None = None, materialize: bool = True) -> DataFrame:
    """Exact `PERCENT_RANK() OVER (ORDER BY col [DESC])` without a one-partition sort.

    1. rows are counted per distinct value (a value held by a third of all rows
       becomes one row);
    2. the distinct values are range-partitioned by Spark in rank order, into as
       many partitions as the session shuffles with (or `buckets`): the number
       of ranges grows with the cluster setting, and equal values are one row;
    3. per range: row total; the exclusive prefix over ranges is computed on that
       table (one row per shuffle partition, the proven bound of its broadcast);
    4. inside a range a window gives the rows ahead of each value;
       rank = 1 + prefix + rows ahead; pr = (rank-1)/(n-1), 0 if n=1.
    NULL values sort first in DESC and last in ASC (PostgreSQL order).

    `df` is read twice, by the counts and by the join back: with
    `materialize=True` it is computed once into the shared checkpoint folder. The
    ranges are fixed by a lazy checkpoint, so both of their readers see the same
    ones. Spark removes such files with the session's
    `spark.cleaner.referenceTracking.cleanCheckpoints`.
    """
    from .sinks import materialise
    if materialize:
        df = materialise(df)
    v = F.col(col)
    order = v.desc_nulls_first() if descending else v.asc_nulls_last()
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("_c"))
    ranges = counts.repartitionByRange(buckets, order) if buckets else counts.repartitionByRange(order)
    ranges = materialise(ranges.withColumn("_b", F.spark_partition_id()), eager=False)
    totals = ranges.groupBy("_b").agg(F.sum("_c").alias("_bt"))
    w_all = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prefix = totals.select("_b", (F.sum("_bt").over(w_all) - F.col("_bt")).alias("_before"),
                           F.sum("_bt").over(Window.partitionBy()).alias("_n"))
    w_in = Window.partitionBy("_b").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (ranges.join(F.broadcast(prefix), "_b")
              .withColumn("_ahead", F.sum("_c").over(w_in) - F.col("_c"))
              .select(col, (F.col("_before") + F.col("_ahead")).alias("_rank0"), "_n"))
    pr = F.when(F.col("_n") > 1, F.col("_rank0").cast("double") / (F.col("_n") - 1).cast("double")).otherwise(0.0)
    ranked = ranked.select(col, pr.alias(out))
    return df.join(ranked, df[col].eqNullSafe(ranked[col]), "inner").drop(ranked[col])


def tier_by_percent_rank(df: DataFrame, col: str, cuts: Sequence[float] = (0.05, 0.10, 0.25, 0.50),
                         labels: Sequence[str] = ("5", "10", "25", "50", "50+"), descending: bool = True,
                         out: str = "customer_group", **kw) -> DataFrame:
    """Label rows by the first cut their percent rank is <= to (last label otherwise)."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("need one label per cut plus one for the rest")
    ranked = percent_rank(df, col, descending=descending, out="_pr", **kw)
    return ranked.withColumn(out, bucket_by_thresholds(F.col("_pr"), cuts, labels, upper_inclusive=True)).drop("_pr")


# --- buckets -------------------------------------------------------------------
def bucket_by_thresholds(x: Column, thresholds: Sequence[float], labels: Sequence[str],
                         upper_inclusive: bool = False) -> Column:
    """CASE bucket of `x`.

    upper_inclusive=True : x <= t0 -> labels[0], x <= t1 -> labels[1], ... else last.
    upper_inclusive=False: thresholds descending, x >= t0 -> labels[0], ... else last.
    """
    e = None
    for t, lab in zip(thresholds, labels):
        cond = (x <= F.lit(t)) if upper_inclusive else (x >= F.lit(t))
        e = F.when(cond, F.lit(lab)) if e is None else e.when(cond, F.lit(lab))
    return e.otherwise(F.lit(labels[-1])) if e is not None else F.lit(labels[-1])


# --- share of total ------------------------------------------------------------
def share_of_total(df: DataFrame, col: str | dict[str, str], out: str | None = None, scale: int = 2) -> DataFrame:
    """`ROUND(100.0 * col / SUM(col) OVER (), scale)` computed exactly (half-up).

    `col` is one column (result in `out`) or a mapping {column: output}; all
    shares come from one window pass. Columns must be non-negative integer
    counts (or money already in cents). The input must be an aggregate over a
    small, bounded key domain (airports, passenger groups): the empty-window
    total runs in one task, over those few rows only.
    """
    cols = {col: out or f"{col}_share_percent"} if isinstance(col, str) else dict(col)
    w = Window.partitionBy()
    return df.withColumns({o: percent_half_up(F.col(c), F.sum(c).over(w), scale) for c, o in cols.items()})


# --- versions ------------------------------------------------------------------
def latest_version(df: DataFrame, parent: Sequence[str] | str, order: Sequence[str] | str = "load_date") -> DataFrame:
    """Latest row per parent (e.g. the current satellite version).

    Per-parent `max_by` over a struct of the ordering columns: an aggregate
    with map-side combine, not a window sort, so a parent with many versions
    is reduced before the shuffle.
    """
    parent = [parent] if isinstance(parent, str) else list(parent)
    order = [order] if isinstance(order, str) else list(order)
    payload = [c for c in df.columns if c not in parent]
    key = F.struct(*[F.col(c) for c in order])
    return (df.groupBy(*parent).agg(F.max_by(F.struct(*[F.col(c) for c in payload]), key).alias("_r"))
            .select(*parent, *[F.col(f"_r.{c}").alias(c) for c in payload]))


def version_order(at: str = "load_date", tie: str | None = "hash_diff") -> Column:
    """Order of a parent's versions as one fixed-width number: the microseconds of `at`, then the
    first 64 bits of the hex digest `tie` (2**64 parts a microsecond: exact in decimal(38) for years beyond 10,000)."""
    micros = F.unix_micros(F.col(at).cast("timestamp")).cast("decimal(38,0)")
    if tie is None:
        return micros
    return (micros * F.lit(str(2 ** 64)).cast("decimal(20,0)") + F.conv(F.substring(tie, 1, 16), 16, 10).cast("decimal(20,0)")).cast("decimal(38,0)")


def newest_version(df: DataFrame, parent: Sequence[str] | str, at: str = "load_date", tie: str | None = "hash_diff") -> DataFrame:
    """Newest row per parent in two steps, without sorting rows or carrying them through an aggregate.

    The newest order number per parent comes from two narrow columns (a hash aggregate: the
    number has a fixed width); whole rows are read once more and only those that have it stay.
    Versions of one parent differ in (at, tie), as a history's do; where two have both alike, both
    stay. A row without `at` or parent is no version.
    """
    parent = [parent] if isinstance(parent, str) else list(parent)
    rows = df.withColumn("_order", version_order(at, tie))
    last = rows.groupBy(*parent).agg(F.max("_order").alias("_order"))
    return rows.join(last, [*parent, "_order"], "left_semi").drop("_order")


def previous_value(df: DataFrame, parent: Sequence[str] | str, order: Sequence[str] | str, value: str,
                   out: str, buckets: int | None = None) -> DataFrame:
    """`LAG(value) OVER (PARTITION BY parent ORDER BY order)` with hot parents split.

    Rows are range-partitioned by (parent, order), so a parent that holds a third
    of all rows spreads over as many tasks as it needs. Inside a range a window
    looks one row back; the first row of a range gets the last row of the range
    before it (one such row per shuffle partition, the proven bound of its broadcast),
    if that has the same parent. Rows of equal parent and order stand in any order.
    """
    from .sinks import materialise
    parent = [parent] if isinstance(parent, str) else list(parent)
    order = [order] if isinstance(order, str) else list(order)
    cols = [*parent, *order]
    ranges = df.repartitionByRange(buckets, *cols) if buckets else df.repartitionByRange(*cols)
    # a lazy checkpoint fixes the ranges: both readers below see the same ones
    ranges = materialise(ranges.withColumn("_b", F.spark_partition_id()), eager=False)
    row = F.struct(F.struct(*parent).alias("p"), F.struct(*order).alias("o"), F.col(value).alias("v"))
    ends = ranges.groupBy("_b").agg(F.max(row).alias("_end"))
    ends = ends.select("_b", F.lag("_end").over(Window.orderBy("_b")).alias("_end"))
    # within equal (parent, order) the value decides, as in the range ends
    w = Window.partitionBy("_b").orderBy(*cols, value)
    back = F.coalesce(F.lag(row).over(w), F.col("_end"))
    with_back = ranges.join(F.broadcast(ends), "_b", "left").withColumn("_back", back)
    same = F.col("_back.p").eqNullSafe(F.struct(*parent))
    return with_back.withColumn(out, F.when(same, F.col("_back.v"))).drop("_b", "_end", "_back")


def mark_changes(df: DataFrame, parent: Sequence[str] | str, order: Sequence[str] | str,
                 hash_col: str = "hash_diff", out: str = "is_change", buckets: int | None = None) -> DataFrame:
    """Flag rows whose hash differs from the previous row of the same parent."""
    seq = previous_value(df, parent, order, hash_col, "_prev", buckets)
    return seq.withColumn(out, F.col("_prev").isNull() | (F.col("_prev") != F.col(hash_col))).drop("_prev")
