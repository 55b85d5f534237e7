"""Join operators: either-endpoint join, role swap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def either_endpoint_join(left: DataFrame, left_key: str, right: DataFrame,
                         endpoint_a: str, endpoint_b: str, how: str = "inner",
                         out_col: str | None = None) -> DataFrame:
    """`left JOIN right ON left.key = right.a OR left.key = right.b` as an equi-join.

    Written with OR, Spark can only plan a nested-loop or Cartesian join. Here
    each right row is emitted once per *distinct* non-NULL endpoint
    (`explode(array_distinct(array(a, b)))`), then equi-joined: a row with
    a = b matches once, exactly like the OR form, and NULL endpoints match
    nothing. The result has all columns of both sides.
    """
    key = out_col or f"_ep_{left_key}"
    exploded = right.withColumn(key, F.explode(F.array_distinct(F.array(F.col(endpoint_a), F.col(endpoint_b)))))
    exploded = exploded.where(F.col(key).isNotNull())
    out = left.join(exploded, left[left_key] == exploded[key], how)
    return out if out_col else out.drop(key)


def swap_roles(df: DataFrame, pairs: Sequence[tuple[str, str]], renames: dict[str, str] | None = None) -> DataFrame:
    """Swap the values of each column pair and rename measure columns.

    `swap_roles(out, [("airport_code", "linked_airport_code")], {"flights_out": "flights_in"})`
    turns outbound rows into the inbound rows of the opposite airport.
    """
    renames = renames or {}
    swap = {}
    for a, b in pairs:
        swap[a], swap[b] = b, a
    cols = []
    for c in df.columns:
        if c in swap:
            cols.append(F.col(swap[c]).alias(c))
        else:
            cols.append(F.col(c).alias(renames.get(c, c)))
    return df.select(*cols)
