"""Connected components of an edge table by alternating large-star and small-star steps.

Edges stay in Spark; each round is a few aggregations and joins on node ids and ends in a stored table, so a lost
executor never costs more than one round.  The number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.sum(F.expr("xxhash64(a, b) >> 20")))
                 .first())


def components(edges: DataFrame) -> DataFrame:
    """``a, b``: every node that is not the least of its component, and that least node (orderable ids)."""
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .filter("a <> b").distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = (both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
                 .distinct())
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (large.join(low, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
                 .union(low.select("a", F.col("low").alias("b"))).distinct())
        now = stored(small, "edges")
        before, state = state, _state(now)
        if state == before:
            break
    return now
