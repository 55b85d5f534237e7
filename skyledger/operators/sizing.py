"""How many partitions a shuffle of large inputs gets."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Of the largest stored table below a plan, for each partition. A task sorts and hashes what it holds, which takes
# some 60 times the room of compressed columns.
PARTITION_BYTES = 4 << 20
_UNKNOWN = 1 << 60  # Spark's size of a source that gives none


def shuffle_partitions(df: DataFrame) -> int:
    """Partitions for a shuffle of rows of `df`: the session's number or, with inputs too large for it, the least
    multiple of it that leaves PARTITION_BYTES of the largest input to each. What a task holds is bounded so, while a
    fixed number, or the one that AQE merges partitions to, lets it grow with the input."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    size = max((s for s in sizes if s < _UNKNOWN), default=0)
    return least * max(1, -(-size // (PARTITION_BYTES * least)))
