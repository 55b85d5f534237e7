"""Hash keys, change hashes, surrogate ids and lineage columns (all JVM-side).

`hash_columns` is the record hash of the history layer: MD5 hex of the values
of the named columns, taken in column-name order. Two encodings:

* default: each value cast to text, NULL written as a marker, values joined
  with a separator that does not occur in keys -> ("ab","c") != ("a","bc").
* compat=True: the plain concatenation of Python-`str` renderings, the way the
  reference's consumer builds its keys (no separator, NULL -> 'None',
  booleans 'True'/'False'). For a single non-NULL text or integer column both
  encodings give MD5 of the value itself.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values (must equal the reference's consumer constants).
RECORD_SOURCE = "airline_tickets_db"
SOURCE_SYSTEM_ID = 1

NULL_MARKER = "\\N"
SEPARATOR = "\u001f"
_NULL_SQL = NULL_MARKER.replace("\\", "\\\\")   # the marker as a SQL string literal body


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text_sql(name: str, dtype: T.DataType | None, compat: bool) -> str:
    c = _q(name)
    if compat and isinstance(dtype, T.BooleanType):
        return f"CASE WHEN {c} THEN 'True' WHEN NOT {c} THEN 'False' END"
    return f"CAST({c} AS STRING)"


def hash_sql(names: Iterable[str], types: dict | None = None, compat: bool = False) -> str:
    """SQL text of the record hash of the named columns (column-name order)."""
    types = types or {}
    names = sorted(names)
    if compat:
        parts = [f"coalesce({_text_sql(n, types.get(n), True)}, 'None')" for n in names]
        return f"md5(concat({', '.join(parts)}))"
    parts = [f"coalesce({_text_sql(n, types.get(n), False)}, '{_NULL_SQL}')" for n in names]
    return f"md5(concat_ws(char({ord(SEPARATOR)}), {', '.join(parts)}))"


def hash_columns(df: DataFrame, cols: Iterable[str], compat: bool = False) -> Column:
    """MD5 (32 hex chars) of the values of `cols`, in column-name order.

    Built as one SQL expression (one call into the JVM however many columns).
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    return F.expr(hash_sql(cols, types, compat))


def surrogate_id_sql(hash_key_sql: str) -> str:
    """SQL text of `surrogate_id` over a hash-key SQL expression."""
    return f"unhex({hash_key_sql})"


def surrogate_id(hash_key: Column) -> Column:
    """Deterministic 16-byte id: the whole hash key in binary.

    Replaces a global sequence: equal business keys get equal ids on every
    executor and every re-run, so links reference hubs without a look-up.
    """
    return F.unhex(hash_key)


def with_lineage(df: DataFrame, load_ts, record_source: str = RECORD_SOURCE,
                 source_system_id: int = SOURCE_SYSTEM_ID) -> DataFrame:
    """Append load_date / record_source / source_system_id."""
    ts = load_ts if isinstance(load_ts, Column) else F.lit(load_ts).cast("timestamp")
    return df.withColumns({
        "load_date": ts,
        "record_source": F.lit(record_source),
        "source_system_id": F.lit(source_system_id).cast("int"),
    })
