"""Approximate nearest neighbours by shifted Hilbert curves.

Each curve projects the vectors on random orthonormal directions, shifts and quantises the projections and orders the
vectors by Hilbert key.  Spark range-partitions every curve by key; the rank on the curve places a vector in a block
of fixed size.  A query's candidates are the vectors within ``window`` ranks of it on any curve: the query travels to the
blocks its window touches, the block's task measures exact distances and keeps the nearest, and the candidates of all
curves merge per query.  No task holds more than a block and a batch of its queries, whatever the keys.

The window is fitted: for ``fit_queries`` rows chosen by hash the true neighbours are found by a full scan in blocks,
and the window is the rank distance that reaches ``recall`` of them on at least one curve, with a margin.  On data without
structure (near-isotropic vectors) it is a large share of the table; on clustered data it is small.

Equal vectors are one point of the index with its 1 + ``k`` smallest ids (ranked per task before any shuffle), which is all
that a list of ``k`` can show, so a vector that a third of the rows share costs one point and ties stay exact.

Defined results: vectors that are NULL, empty, zero, of another length than most rows' or hold a NULL or non-finite
component take no part, as do rows with a NULL id; repeated rows (same id and vector) are one candidate; fewer than ``k``
candidates give a shorter list; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import map_arrow, ship, stored


@dataclass
class Curves:
    """Projections, shifts and scales of all curves."""

    directions: np.ndarray  # curves x dimension x axes
    low: np.ndarray
    span: np.ndarray
    shift: np.ndarray
    bits: int

    def keys(self, vectors: np.ndarray, curve: int) -> np.ndarray:
        place = (vectors @ self.directions[curve] - self.low[curve]) / self.span[curve]
        cells = np.clip((place + self.shift[curve]) / 1.5 * (1 << self.bits), 0, (1 << self.bits) - 1)
        return hilbert(cells.astype(np.int64), self.bits)


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index (int64) of cells (n x axes, each below 2**bits), by Gray codes and axis rotations, all rows at once."""
    x = cells.T.copy()
    axes = len(x)
    for level in range(bits - 1, 0, -1):
        below = (1 << level) - 1
        for i in range(axes):
            inverts = (x[i] >> level & 1).astype(bool)
            swap = np.where(inverts, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(inverts, below, swap)
            if i:
                x[i] ^= swap
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> level & 1, (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros(cells.shape[0], dtype=np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(axes):
            key = key << 1 | (x[i] >> level & 1)
    return key


def _packed(x: np.ndarray) -> list[bytes]:
    """Vectors as single-precision bytes: enough to choose candidates by, and half the size on every curve."""
    return [row.tobytes() for row in x.astype("<f4")]


def _unpacked(rows) -> np.ndarray:
    return np.frombuffer(b"".join(rows), dtype="<f4").reshape(len(rows), -1).astype(np.float64)


def _vectors(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64) if len(column) else np.zeros((0, 1))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances, rough (by inner products): fit for choosing, not for reporting."""
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


# ------------------------------------------------------------------ points
def points(vectors: DataFrame, id_col: str, vector_col: str, k: int) -> DataFrame:
    """Distinct valid vectors, stored: ``point`` (smallest id), ``vec`` and ``ids`` (the 1 + k smallest)."""
    v = F.col("vec")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
    valid = rows.filter(F.col("id").isNotNull() & (F.size(v) > 0)
                        & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
                        & F.exists(v, lambda x: x != 0))
    valid = valid.withColumn("vec", F.transform(v, lambda x: x + F.lit(0.0)))  # -0.0 is 0.0
    size = valid.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    valid = valid.filter(F.size("vec") == (size["n"] if size else 0))
    ranked = valid.withColumn("rank", F.dense_rank().over(Window.partitionBy("vec").orderBy("id")))
    few = ranked.filter(F.col("rank") <= k + 1).groupBy("vec").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    return stored(few.select(F.get("ids", F.lit(0)).alias("point"), "vec", "ids"), "points")


def fit_curves(index: DataFrame, n: int, curves: int, axes: int, bits: int, seed: int, sample: int = 20_000) -> Curves:
    """Scales from about ``sample`` points chosen by hash."""
    some = index.filter(F.pmod(F.xxhash64("point"), F.lit(1 << 30)) < int(min(1.0, sample / n) * (1 << 30)))
    x = np.array([r["vec"] for r in some.select("vec").limit(2 * sample).collect()] or
                 [index.select("vec").first()["vec"]])
    rng, d = np.random.default_rng(seed), x.shape[1]
    axes = min(axes, d)
    directions = np.stack([np.linalg.qr(rng.normal(size=(d, d)))[0][:, :axes] for _ in range(curves)])
    place = np.einsum("nd,cda->cna", x, directions)
    low, high = place.min(axis=1), place.max(axis=1)
    return Curves(directions, low, np.maximum(high - low, 1e-9), rng.uniform(0, 0.5, (curves, axes)),
                  min(bits, 62 // axes))


def ranked_curves(index: DataFrame, curves: Curves) -> DataFrame:
    """One row per curve and point, stored: curve, point, vec and its ``rank`` on the curve."""
    number = len(curves.directions)

    def keyed(batches):
        for batch in batches:
            x = _vectors(batch.column("vec"))
            packed = pa.array(_packed(x), pa.binary())
            for c in range(number if batch.num_rows else 0):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), c, np.int32)), pa.array(curves.keys(x, c)), batch.column("point"),
                     packed], names=["curve", "key", "point", "vec"])

    rows = map_arrow(index.select("point", "vec"), keyed, "curve int, key long, point long, vec binary")
    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["curve", "key", "point"]
    spread = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def numbered(batches):
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            c = batch.column("curve").to_numpy()
            nth = np.empty(len(c), np.int64)
            for one in np.unique(c):
                mine = np.flatnonzero(c == one)
                nth[mine] = seen.get(int(one), 0) + np.arange(len(mine))
                seen[int(one)] = int(nth[mine[-1]]) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("curve"), batch.column("point"), batch.column("vec"),
                 pa.array(np.full(len(c), part, np.int32)), pa.array(nth)], names=["curve", "point", "vec", "part", "nth"])

    placed = stored(map_arrow(spread, numbered, "curve int, point long, vec binary, part int, nth long"), "curves")
    counts = placed.groupBy("curve", "part").count()  # a row per curve and partition
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("curve", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    return placed.join(first, ["curve", "part"]).select("curve", "point", "vec",
                                                       (F.col("before") + F.col("nth")).alias("rank"))


def fit_window(index: DataFrame, ranked: DataFrame, n: int, k: int, recall: float, fit_queries: int,
               margin: float) -> int:
    """Ranks on either side of a query that reach ``recall`` of the true neighbours, for a bounded sample of queries."""
    some = index.filter(F.pmod(F.xxhash64("point", F.lit("fit")), F.lit(1 << 30))
                        < int(min(1.0, fit_queries / n) * (1 << 30)))
    sample = [(r["point"], r["vec"]) for r in some.select("point", "vec").limit(2 * fit_queries).collect()]
    if not sample:
        return n
    ids, q = np.array([p for p, _ in sample]), np.array([v for _, v in sample])

    def nearest(batches):  # the k nearest of this partition for each query of the sample
        best_d, best_p = np.full((len(q), 0), np.inf), np.zeros((len(q), 0), np.int64)
        for batch in batches:
            if batch.num_rows:
                p = batch.column("point").to_numpy()
                d = _distances(q, _vectors(batch.column("vec")))
                d[ids[:, None] == p[None]] = np.inf
                best_d = np.hstack([best_d, d])
                best_p = np.hstack([best_p, np.broadcast_to(p, d.shape)])
                top = np.argsort(best_d, axis=1, kind="stable")[:, :k]
                best_d, best_p = np.take_along_axis(best_d, top, 1), np.take_along_axis(best_p, top, 1)
        i, j = np.nonzero(np.isfinite(best_d))
        yield pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(best_p[i, j]), pa.array(best_d[i, j])],
                                         names=["query", "point", "d"])

    found = map_arrow(index.select("point", "vec"), nearest, "query long, point long, d double")
    top = Window.partitionBy("query").orderBy("d", "point")
    true = found.withColumn("n", F.row_number().over(top)).filter(F.col("n") <= k).select("query", "point")
    at = ranked.select("curve", "point", "rank")
    asked = at.join(F.broadcast(some.select("point").limit(2 * fit_queries)), "point") \
        .select("curve", F.col("point").alias("query"), F.col("rank").alias("of"))
    gaps = (at.join(true, "point").join(asked, ["curve", "query"])
            .groupBy("query", "point").agg(F.min(F.abs(F.col("rank") - F.col("of"))).alias("gap")))
    gap = sorted(r["gap"] for r in gaps.select("gap").collect())  # at most 2 x fit_queries x k rows
    return int(np.ceil(margin * gap[min(len(gap) - 1, int(recall * len(gap)))])) if gap else n


# ------------------------------------------------------------------ search
def search(vectors: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
           curves: int = 24, axes: int = 12, bits: int = 5, recall: float = 0.95, fit_queries: int = 256,
           margin: float = 1.2, block: int = 4096, spare: int = 6, seed: int = 11) -> DataFrame:
    """The ``k`` nearest found of every row whose id satisfies ``is_query`` (a function of the id column).

    query_id, rank (from 1), vec_id, score (Euclidean distance in double precision).
    """
    spark = vectors.sparkSession
    ship(spark)
    index = points(vectors, id_col, vector_col, k)
    n = index.count()
    out = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], out)
    ranked = stored(ranked_curves(index, fit_curves(index, n, curves, axes, bits, seed)), "ranked")
    window = fit_window(index, ranked, n, k, recall, fit_queries, margin)
    ids = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
    # every query row, with the point its vector is
    asked = ids.filter(is_query(F.col("id"))).select(
        F.col("id").alias("query_id"), F.transform("vec", lambda x: x + F.lit(0.0)).alias("vec")).distinct()
    asked = stored(asked.join(index.select("vec", "point"), "vec").select("query_id", "point"), "queries")
    wanted = ranked.join(asked.select("point").distinct(), "point", "left_semi")
    sent = wanted.select("curve", F.explode(F.sequence(
        F.floor(F.greatest(F.col("rank") - window, F.lit(0)) / block),
        F.floor(F.least(F.col("rank") + window, F.lit(n - 1)) / block))).alias("block"),
        F.col("point").alias("query"), "vec", "rank")
    held = ranked.select(F.col("curve").alias("on"), F.floor(F.col("rank") / block).alias("at"),
                         F.col("point").alias("near"), F.col("vec").alias("there"), F.col("rank").alias("place"))

    def measure(q: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        """Of one block: the nearest points inside the window of each query (a few more than k, as distances are
        rough here), and the query's own point."""
        x, p, r = _unpacked(held["there"].tolist()), held["near"].to_numpy(), held["place"].to_numpy()
        rows = []
        for at in range(0, len(q), 256):
            part = q.iloc[at:at + 256]
            d = _distances(_unpacked(part["vec"].tolist()), x)
            d[np.abs(part["rank"].to_numpy()[:, None] - r[None]) > window] = np.inf
            d[part["query"].to_numpy()[:, None] == p[None]] = -1.0  # equal vectors are nearest of all
            few = min(k + spare, d.shape[1])
            top = np.argpartition(d, few - 1, axis=1)[:, :few]
            for i, query in enumerate(part["query"].to_numpy()):
                j = top[i][np.isfinite(d[i, top[i]])]
                rows.append(pd.DataFrame({"query": query, "point": p[j]}))
        return pd.concat(rows) if rows else pd.DataFrame({"query": [], "point": []})

    found = (sent.groupBy("curve", "block").cogroup(held.groupBy("on", "at"))
             .applyInPandas(_if_both(measure), "query long, point long")).distinct()
    pairs = (found.join(index.select("point", F.col("vec").alias("there"), "ids"), "point")
             .join(index.select(F.col("point").alias("query"), "vec"), "query"))
    square = F.aggregate(F.zip_with("vec", "there", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    measured = pairs.select("query", "ids", F.sqrt(square).alias("score"))
    first = Window.partitionBy("query").orderBy("score", F.get("ids", F.lit(0)))
    near = measured.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k + 1)
    listed = (asked.join(near, F.col("point") == F.col("query"))
              .select("query_id", "score", F.explode("ids").alias("vec_id")).filter("query_id <> vec_id"))
    top = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (listed.withColumn("rank", F.row_number().over(top)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def _if_both(measure):
    def of(q: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if len(q) and len(held):
            return measure(q, held)
        return pd.DataFrame({"query": pd.Series([], dtype="int64"), "point": pd.Series([], dtype="int64")})

    return of
