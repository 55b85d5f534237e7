"""Data-quality operators: value rules, non-empty, keys, schema limits, table diff.

Every check is a distributed aggregate or anti-join; only the violation
counts (one number per rule) reach the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class DataQualityError(Exception):
    """Raised by a check before anything is published."""


def rule_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row: for each rule, the number of rows violating it (single pass)."""
    return df.agg(*[F.count_if(F.coalesce(pred, F.lit(False))).alias(name) for name, pred in rules.items()])


def check_rules(df: DataFrame, rules: Mapping[str, Column]) -> dict[str, int]:
    """Raise DataQualityError if any row violates any rule; return the counts."""
    counts = rule_counts(df, rules).first().asDict()
    bad = {k: v for k, v in counts.items() if v}
    if bad:
        raise DataQualityError(f"Data validation failed: invalid values detected {bad}")
    return counts


def check_not_empty(df: DataFrame) -> int:
    """Raise if `df` has no row (reads at most one row)."""
    if df.limit(1).count() == 0:
        raise DataQualityError("No data found for target date")
    return 1


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values present more than once, with their multiplicity."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def check_unique(df: DataFrame, keys: Sequence[str]) -> None:
    if duplicate_keys(df, keys).limit(1).count():
        raise DataQualityError(f"duplicate values of key {list(keys)}")


def orphans(child: DataFrame, child_cols: Sequence[str], parent: DataFrame,
            parent_cols: Sequence[str]) -> DataFrame:
    """Child rows whose (non-NULL) reference has no parent row (FOREIGN KEY)."""
    p = parent.select(*[F.col(a).alias(f"_p{i}") for i, a in enumerate(parent_cols)]).distinct()
    cond = None
    for i, c in enumerate(child_cols):
        e = child[c] == p[f"_p{i}"]
        cond = e if cond is None else cond & e
    not_null = None
    for c in child_cols:
        e = F.col(c).isNotNull()
        not_null = e if not_null is None else not_null & e
    return child.where(not_null).join(p, cond, "left_anti")


def check_foreign_key(child, child_cols, parent, parent_cols) -> None:
    if orphans(child, child_cols, parent, parent_cols).limit(1).count():
        raise DataQualityError(f"foreign key {list(child_cols)} has orphans")


def schema_rules(schema: T.StructType, columns: Sequence[str],
                 text_limits: Mapping[str, tuple[str, int]] | None = None) -> dict[str, Column]:
    """Predicates of NOT NULL and CHAR/VARCHAR length violations of the columns present."""
    rules = {}
    for f in schema.fields:
        if not f.nullable and f.name in columns:
            rules[f"{f.name}_null"] = F.col(f.name).isNull()
    for col, (kind, n) in (text_limits or {}).items():
        if col in columns:
            ln = F.length(F.col(col))
            rules[f"{col}_length"] = (ln != n) if kind == "char" else (ln > n)
    return rules


def schema_violations(df: DataFrame, schema: T.StructType,
                      text_limits: Mapping[str, tuple[str, int]] | None = None) -> DataFrame:
    """One row with per-column counts of NOT NULL and CHAR/VARCHAR length violations."""
    return rule_counts(df, schema_rules(schema, df.columns, text_limits))


def check_contract(df: DataFrame, schema: T.StructType, key: Sequence[str]) -> None:
    """Raise unless `df` has the columns and types of `schema`, no NULL where it forbids
    one, and `key` unique: what a table definition would refuse on insert."""
    got = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in schema.fields}
    if got != want:
        raise DataQualityError(f"columns differ from the declared ones: {set(got.items()) ^ set(want.items())}")
    check_rules(df, schema_rules(schema, df.columns))
    check_unique(df, key)


# --- many constraints in one pass ----------------------------------------------------
@dataclass
class Constraints:
    """Declared constraints of a set of tables.

    keys: (check, table, columns): no value twice (NULL counts as a value).
    references: (check, table, columns, parent table, parent columns): every value
    without a NULL occurs in the parent.
    rules: (check, table, predicate): no row for which the predicate holds.
    """
    keys: list[tuple[str, str, list[str]]] = field(default_factory=list)
    references: list[tuple[str, str, list[str], str, list[str]]] = field(default_factory=list)
    rules: list[tuple[str, str, Column]] = field(default_factory=list)


class _Domain:
    """One key of one table: the checks that it is unique, and those whose rows refer to it."""

    def __init__(self, number: int, types: Sequence[T.DataType] = ()):
        self.number, self.types = number, list(types)
        self.keys: list[str] = []
        self.references: list[str] = []

    def places(self) -> list[str]:
        """The record column of each key column: one for each type and its turn."""
        names = [t.simpleString() for t in self.types]
        return [f"_{n}_{names[:i].count(n)}" for i, n in enumerate(names)]


def violation_report(tables: Mapping[str, DataFrame], c: Constraints) -> DataFrame:
    """One row per constraint: (check_name, violations). A key counts its repeated
    values, a reference its rows without a parent, a rule the rows that break it.

    Every table is read once: a row gives one small record for each key it holds and
    each reference it makes (for a rule only if it breaks it). Values keep their types,
    and a parent's key is one record however many references lead to it. All records
    meet in one hash aggregate by (key, value), which combines on the map side, so a
    value that a third of the rows hold is one record a task; a second, tiny one
    counts per constraint.
    """
    domains: dict[tuple, _Domain] = {}

    def domain(table: str, cols: Sequence[str]) -> _Domain:
        at = (table, tuple(cols))
        if at not in domains:
            domains[at] = _Domain(len(domains), [tables[table].schema[x].dataType for x in cols])
        return domains[at]

    for check, table, cols in c.keys:
        domain(table, cols).keys.append(check)
    for check, table, cols, ptable, pcols in c.references:
        d = domain(ptable, pcols)
        d.references.append(check)
        for i, x in enumerate(cols):  # values of unlike types are compared as text
            if tables[table].schema[x].dataType != d.types[i]:
                d.types[i] = T.StringType()
    for check, table, _ in c.rules:
        domains[(table, check)] = _Domain(len(domains))
        domains[(table, check)].references.append(check)
    columns = {p: t for d in domains.values() for p, t in zip(d.places(), d.types)}

    def record(d: _Domain, cols: Sequence[str], slot: int) -> Column:
        own = {p: F.col(f"`{x}`").cast(t) for p, x, t in zip(d.places(), cols, d.types)}
        return F.struct(F.lit(d.number).alias("domain"), F.lit(slot).alias("slot"),
                        *[own.get(p, F.lit(None).cast(t)).alias(p) for p, t in columns.items()])

    per_table: dict[str, list[Column]] = {}
    for (table, cols), d in domains.items():
        if d.types:
            per_table.setdefault(table, []).append(record(d, cols, -1))
    for check, table, cols, ptable, pcols in c.references:
        d = domain(ptable, pcols)
        present = F.lit(True)
        for x in cols:
            present = present & F.col(f"`{x}`").isNotNull()
        per_table.setdefault(table, []).append(F.when(present, record(d, cols, d.references.index(check))))
    for check, table, broken in c.rules:
        per_table.setdefault(table, []).append(F.when(F.coalesce(broken, F.lit(False)), record(domains[(table, check)], [], 0)))
    records = None
    for table, recs in per_table.items():
        r = tables[table].select(F.explode(F.filter(F.array(*recs), lambda x: x.isNotNull())).alias("r")).select("r.*")
        records = r if records is None else records.unionByName(r)
    slots = range(max((len(d.references) for d in domains.values()), default=0))
    by_value = records.groupBy("domain", *columns).agg(F.count_if(F.col("slot") == -1).alias("held"),
                                                      *[F.count_if(F.col("slot") == j).alias(f"made_{j}") for j in slots])
    counts = by_value.groupBy("domain").agg(F.count_if(F.col("held") > 1).alias("v_-1"),
                                            *[F.sum(F.when(F.col("held") == 0, F.col(f"made_{j}")).otherwise(0)).alias(f"v_{j}") for j in slots])
    found = counts.select("domain", F.explode(F.array(*[F.struct(F.lit(j).alias("slot"), F.col(f"`v_{j}`").alias("violations")) for j in (-1, *slots)])).alias("r"))
    # a constraint without any record still has its row
    names = [(d.number, -1, k) for d in domains.values() for k in d.keys] + [(d.number, j, k) for d in domains.values() for j, k in enumerate(d.references)]
    checks = records.sparkSession.createDataFrame(names, "domain int, slot int, check_name string")
    return (checks.join(found.select("domain", "r.*"), ["domain", "slot"], "left")
            .select("check_name", F.coalesce("violations", F.lit(0)).cast("long").alias("violations")))


def table_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows in one table but not the other (multiset), tagged 'a' or 'b'.

    Empty result <=> both tables hold the same rows with the same multiplicity.
    """
    cols = sorted(a.columns)
    a, b = a.select(*cols), b.select(*cols)
    return (a.exceptAll(b).withColumn("side", F.lit("a"))
            .unionByName(b.exceptAll(a).withColumn("side", F.lit("b"))))


def bucket_digests(df: DataFrame, keys: Sequence[str], buckets: int = 1024) -> DataFrame:
    """(bucket, n, total, mixed): order-free digests of the rows of each bucket of the keys.

    One hash aggregate over fixed-width numbers; at most `buckets` rows come out. Equal rows in any
    order and partitioning give equal digests, and a repeated row counts as often as it occurs.
    """
    # a hash passes over NULLs, so each column goes with whether it is one
    cells = [x for c in sorted(df.columns) for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    rows = df.select(_bucket(keys, buckets).alias("bucket"), F.xxhash64(*cells).alias("h"), F.xxhash64(F.lit("mixed"), *cells).alias("x"))
    return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(20,0)")).alias("total"),
                                      F.bit_xor("x").alias("mixed"))


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")


def differing_buckets(a: DataFrame, b: DataFrame) -> DataFrame:
    """Buckets whose digests differ between two tables (of `bucket_digests`, one may be stored)."""
    x, y = (d.select("bucket", F.struct("n", "total", "mixed").alias(name)) for d, name in ((a, "_x"), (b, "_y")))
    return x.join(y, "bucket", "full").where(~F.col("_x").eqNullSafe(F.col("_y"))).select("bucket")


def table_diff_by_digest(a: DataFrame, b: DataFrame, keys: Sequence[str], buckets: int = 1024) -> DataFrame:
    """`table_diff` that compares rows only where the digests of a key bucket differ: of equal tables no row is
    shuffled, and of nearly equal ones few. The list of differing buckets (`buckets` rows at most) goes to all tasks."""
    differ = F.broadcast(differing_buckets(bucket_digests(a, keys, buckets), bucket_digests(b, keys, buckets)))
    a, b = (t.withColumn("bucket", _bucket(keys, buckets)).join(differ, "bucket", "left_semi").drop("bucket") for t in (a, b))
    return table_diff(a, b)
