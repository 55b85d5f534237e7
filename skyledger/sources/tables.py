"""Readers for the booking-model tables (parquet files or a JDBC database)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import OLTP


def read_tables(spark: SparkSession, path: str, names=tuple(OLTP), fmt: str = "parquet") -> dict[str, DataFrame]:
    """`{name: DataFrame}` for tables stored as `<path>/<name>` (parquet by default).

    The declared schema is applied, so a file with an unexpected type fails at
    read time instead of inside a query.
    """
    out = {}
    for n in names:
        reader = spark.read.format(fmt)
        if fmt != "parquet":
            reader = reader.schema(OLTP[n])
        out[n] = reader.load(f"{path.rstrip('/')}/{n}")
    return out


def read_jdbc_tables(spark: SparkSession, url: str, properties: dict, schema: str = "public",
                     names=tuple(OLTP), partitioning: dict | None = None) -> dict[str, DataFrame]:
    """Same tables read through JDBC (no driver jar is bundled; needs one on the cluster).

    `partitioning` maps a table to `(column, lower, upper, num_partitions)` so big
    tables are read by many tasks in parallel instead of one connection.
    """
    out = {}
    for n in names:
        part = (partitioning or {}).get(n)
        if part:
            col, lo, hi, num = part
            out[n] = spark.read.jdbc(url, f"{schema}.{n}", column=col, lowerBound=lo, upperBound=hi,
                                     numPartitions=num, properties=properties)
        else:
            out[n] = spark.read.jdbc(url, f"{schema}.{n}", properties=properties)
    return out


def write_tables(tables: dict[str, DataFrame], path: str, mode: str = "overwrite") -> None:
    for n, df in tables.items():
        df.write.mode(mode).parquet(f"{path.rstrip('/')}/{n}")
