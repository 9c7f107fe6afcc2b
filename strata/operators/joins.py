"""Dimension joins with a *checked* broadcast.

A dimension is broadcast only when the optimizer's size estimate of the plan
is below a bound; otherwise the join stays a shuffle join and AQE may still
convert it at run time from real shuffle statistics.  The estimate comes from
the optimized logical plan (file sizes for Parquet scans, row counts after
aggregation when stats are known).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The estimate is mostly compressed on-disk size; the broadcast hash table is several times larger.
DEFAULT_BROADCAST_BYTES = 32 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of ``df`` in bytes, or None when unavailable."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()  # py4j: Scala BigInt -> int
    except Exception:  # noqa: BLE001 - e.g. Spark Connect: no JVM handle
        return None
    return int(size) if isinstance(size, int) else int(str(size))


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when its estimated size is known and ≤ ``max_bytes``; else ``df``."""
    size = estimated_bytes(df)
    if size is not None and size <= max_bytes:
        return F.broadcast(df)
    return df


def one_per_key(dim: DataFrame, key: str) -> DataFrame:
    """One row per key: of several the least, column by column order, so that a join never multiplies facts."""
    rest = [c for c in dim.columns if c != key]
    row = F.struct(*rest)
    return dim.groupBy(key).agg(F.min(row).alias("row")).select(
        *[key if c == key else F.col("row")[c].alias(c) for c in dim.columns])


def left_join_dim(facts: DataFrame, dim: DataFrame, key: str, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``facts LEFT JOIN dim USING (key)``: unmatched keys (and NULL keys) keep NULL attributes.

    The size check sees the dimension as it is stored.  A small one is read by one task, so that finding one row per key
    shuffles nothing; a large one is grouped and joined by shuffles.
    """
    size = estimated_bytes(dim)
    if size is not None and size <= max_bytes:
        return facts.join(F.broadcast(one_per_key(dim.coalesce(1), key)), key, "left")
    return facts.join(one_per_key(dim, key), key, "left")
