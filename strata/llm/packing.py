"""Best-fit packing of token sequences by a configuration linear program.

A *configuration* is a multiset of piece lengths that fits one sequence.  The program asks for the fewest
sequences such that every length of the histogram is covered.  Multiplicative weights solve it: each length
holds a weight, a knapsack dynamic program finds the configuration of the greatest weight (the pricing step),
that configuration gets a step, and the weights of the lengths it covers fall.  The fractional plan is rounded
down, fullest configurations first, and what is left is filled by priced configurations of the remaining counts,
each topped up with the best-fitting length.

Only the histogram (at most ``capacity`` rows) reaches the driver.  Pieces get their place by rank: the r-th
piece of a length takes the r-th slot the plan holds for it, an arithmetic lookup in each task.

Defined results: NULL text packs as empty text; an empty document is its end token alone; repeated rows and NULL
ids are packed like any other row; an empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import arrow_schema, map_arrow, stored
from strata.llm.encode import encoder


# ------------------------------------------------------------------ pieces
def pieces(docs: DataFrame, vocabulary: str, max_tokens: int = 1024, end_id: int = 2, id_col: str = "doc_id",
           text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, its task ``part`` and its rank ``nth`` there."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([
        source.schema["doc_id"], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
        T.StructField("part", T.IntegerType()), T.StructField("nth", T.LongType()),
        *([T.StructField("ids", T.BinaryType())] if keep_ids else [])])
    arrow = arrow_schema(schema)
    end = np.uint32(end_id).astype("<u4").tobytes()

    def cut(batches):
        enc, seen, part = encoder(vocabulary, keep_space=True), Counter(), TaskContext.get().partitionId()
        for batch in batches:
            row, piece, start, length, crc, nth, ids = [], [], [], [], [], [], []
            for i, text in enumerate(batch.column("text")):
                raw = memoryview(enc.encode(text.as_py()) + end)
                at, n, total = 0, 0, len(raw) // 4
                while at < total:
                    size = (total - at - 1) % max_tokens + 1  # the first piece takes what full pieces leave
                    body = raw[4 * at:4 * (at + size)]
                    row.append(i)
                    piece.append(n)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(body))
                    nth.append(seen[size])
                    if keep_ids:
                        ids.append(bytes(body))
                    seen[size] += 1
                    at, n = at + size, n + 1
            columns = [batch.column("doc_id").take(pa.array(row, pa.int64())), piece, start, length, crc,
                       [part] * len(row), nth, *([ids] if keep_ids else [])]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return map_arrow(source, cut, schema)


# ------------------------------------------------------------------ plan
def _price(value: np.ndarray, capacity: int) -> list[int]:
    """Lengths of the configuration of greatest value: unbounded knapsack over capacities 1 to ``capacity``."""
    best = np.zeros(capacity + 1)
    pick = np.zeros(capacity + 1, dtype=np.int64)
    for c in range(1, capacity + 1):
        with_length = best[c - 1::-1] + value[1:c + 1] if c > 1 else best[:1] + value[1:2]
        k = int(with_length.argmax())
        if with_length[k] > best[c - 1]:
            best[c], pick[c] = with_length[k], k + 1
        else:
            best[c] = best[c - 1]
    out, c = [], capacity
    while c > 0:
        if pick[c]:
            out.append(int(pick[c]))
            c -= int(pick[c])
        else:
            c -= 1
    return out


def solve(histogram: dict[int, int], capacity: int, rate: float = 1.0, lean: float = 1.0, rounds: int = 3000) -> list[tuple[tuple[int, ...], int]]:
    """``[(lengths of one sequence, how many such sequences)]`` that places every piece exactly once."""
    need = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        if not 1 <= length <= capacity:
            raise ValueError(f"length {length} does not fit a sequence of {capacity}")
        need[length] = n
    plan: Counter = Counter()
    if need[capacity]:
        plan[(capacity,)] = int(need[capacity])
        need[capacity] = 0
    lengths = np.flatnonzero(need)
    if not len(lengths):
        return list(plan.items())

    # multiplicative weights; a weight starts near the share of a sequence its length fills
    share = np.arange(capacity + 1) / capacity
    base = share * (1 + lean * share)  # a little more for long pieces, which are the hardest to place
    value = np.where(need > 0, base, -np.inf)
    covered, steps = np.zeros(capacity + 1), Counter()
    step = min(1.0, max(0.05, len(lengths) / 600))  # of the least need a configuration meets: few lengths, small steps
    for _ in range(rounds):
        if (covered[lengths] >= need[lengths]).all():
            break
        config = Counter(_price(value, capacity))
        size = max(1.0, step * min(need[k] / a for k, a in config.items()))
        steps[tuple(sorted(config.elements(), reverse=True))] += size
        for k, a in config.items():
            covered[k] += a * size
            value[k] *= np.exp(-rate * a * size / need[k])

    # rounding: whole steps without what covers a length twice, fullest configurations first
    left = need.copy()

    def place(config: tuple[int, ...], most: int | None) -> None:
        counts = Counter(config)
        n = min(int(left[k]) // a for k, a in counts.items())
        n = n if most is None else min(n, most)
        if n:
            plan[config] += n
            for k, a in counts.items():
                left[k] -= a * n

    for config, size in sorted(steps.items(), key=lambda x: (-sum(x[0]), tuple(-k for k in x[0]))):
        place(config, int(size * min(1.0, *(need[k] / covered[k] for k in config))))

    # what is left: priced anew on the remaining counts
    while left.any():
        value = np.where(left > 0, base, -np.inf)
        config, room, free = [], capacity, left.copy()
        for k in sorted(_price(value, capacity), reverse=True):
            if free[k]:
                config.append(k)
                free[k] -= 1
                room -= k
        while room and (fits := np.flatnonzero(free[:room + 1])).size:  # top up with the best fit
            config.append(int(fits[-1]))
            free[fits[-1]] -= 1
            room -= int(fits[-1])
        place(tuple(sorted(config, reverse=True)), None)
    return list(plan.items())


class _Slots:
    """Where the r-th piece of a length goes: sequence and offset."""

    def __init__(self, plan: list[tuple[tuple[int, ...], int]]):
        found: dict[int, list[tuple[int, int, int, int]]] = {}
        sequence = 0
        for config, n in plan:
            at = 0
            for k, a in sorted(Counter(config).items(), reverse=True):
                found.setdefault(k, []).append((n * a, sequence, a, at))
                at += k * a
            sequence += n
        self.sequences = sequence
        self._by = {}
        for k, rows in found.items():
            slots, first, per, at = (np.array(x, dtype=np.int64) for x in zip(*rows))
            self._by[k] = (np.concatenate([[0], np.cumsum(slots)]), first, per, at)

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for k in np.unique(length):
            mine = length == k
            starts, first, per, at = self._by[int(k)]
            j = np.searchsorted(starts, rank[mine], side="right") - 1
            inside = rank[mine] - starts[j]
            sequence[mine] = first[j] + inside // per[j]
            offset[mine] = at[j] + inside % per[j] * k
        return sequence, offset


# ------------------------------------------------------------------ operator
def pack(cut: DataFrame, capacity: int) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to stored pieces (``length``, ``part`` and ``nth`` as of ``pieces``)."""
    spark = cut.sparkSession
    by_part = cut.groupBy("length", "part").count()
    histogram = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    slots = _Slots(solve(histogram, capacity))
    # stored, so that Spark knows its true size: a broadcast while it is small, else a shuffled join
    first = stored(by_part.select(
        "length", "part",
        (F.sum("count").over(Window.partitionBy("length").orderBy("part")) - F.col("count")).alias("before")), "ranks")
    ranked = (cut.join(first, ["length", "part"])
              .withColumn("rank", F.col("before") + F.col("nth")).drop("before", "part", "nth"))
    names = [c for c in cut.columns if c not in ("part", "nth")]
    schema = T.StructType([*(cut.schema[c] for c in names), T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])
    plan = spark.sparkContext.broadcast(slots)  # at most a few thousand configurations, whatever the input

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                sequence, offset = plan.value.place(batch.column("length").to_numpy(zero_copy_only=False),
                                                    batch.column("rank").to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)],
                    names=[*names, "sequence_id", "offset"])

    return map_arrow(ranked, assign, schema)


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id",
                   text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Texts cut into pieces of at most ``capacity`` tokens and packed; ``keep_ids`` adds the ids of each piece.

    The pieces are stored once (ids only with ``keep_ids``), so texts are read and encoded a single time.
    """
    return pack(stored(pieces(docs, vocabulary, capacity, end_id, id_col, text_col, keep_ids), "pieces"), capacity)
