"""Near duplicates by SimHash fingerprints and pigeonhole blocks.

A fingerprint has 64 bits; bit i is set where more than half of the shingle hashes have it.  Fingerprints that differ in
at most ``max_bits`` bits, cut into ``blocks`` blocks, agree in at least ``blocks - max_bits`` of them: one join key
per choice of that many blocks finds every close pair (7 blocks and 4 bits: 35 keys of 27 to 28 bits).  Inside a key the
Hamming distance is verified, and only a spanning forest of the links is emitted, never all pairs: a search
from the least fingerprint takes every one in reach out of the rest.  Exact copies are one fingerprint before that.

A key shared by more than ``max_bucket`` distinct fingerprints is not held in one task: it is dealt again by the same
rule over the bits that are still free, which loses no pair and ends when few enough bits are free.

Defined results: NULL and empty texts and texts without words have fingerprint zero and link like any other; the component
is the smallest id reachable (NULL ids are ignored; NULL if there is no other); repeated rows are rows; an empty
table gives no rows; other columns are not read (or, in ``drop_near_duplicates``, pass through).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_arrow, ship, stored
from strata.llm.connected import components

_FP, _ROW = "strata_simhash", "strata_simhash_row"
_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("fixed", pa.int64()), ("key", pa.int64())])


def simhash(raw: bytes | None, shingle: int) -> int:
    """The unsigned fingerprint of a UTF-8 text."""
    import xxhash

    words = (raw or b"").lower().split()  # bytes: A-Z only, and the six ASCII white-space characters
    if not words:
        return 0
    text = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(text, seed=42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        digest = xxhash.xxh64_intdigest
        hashes = [digest(text[a:b], 42) for a, b in zip(starts[:1 - shingle].tolist(), ends[shingle - 1:].tolist())]
    every = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(every), 1 << 16):
        counts += np.unpackbits(every[at:at + (1 << 16)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(every), bitorder="little").view("<u8")[0])


def fingerprint(df: DataFrame, text_col: str, shingle: int):
    """Column of the signed 64-bit fingerprint of a text column."""
    ship(df.sparkSession)

    @F.pandas_udf("long")
    def of(raw: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash(x, shingle) for x in raw], dtype=np.uint64).view(np.int64))

    return of(F.col(text_col).cast("binary"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _masks(free: int, blocks: int, agree: int) -> list[int]:
    """Masks of every choice of ``agree`` blocks out of the set bits of ``free``, cut into ``blocks`` blocks."""
    bits = [i for i in range(64) if free >> i & 1]
    parts = [sum(1 << int(i) for i in x) for x in np.array_split(bits, blocks)]
    return [sum(c) for c in combinations(parts, agree)]


def forest(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of one key: each fingerprint with the least one of its component inside the key."""
    child, parent, rest = [], [], np.sort(fps)
    while len(rest) > 1:
        root, rest, todo = rest[0], rest[1:], [rest[0]]
        while todo and len(rest):
            near = np.bitwise_count(rest ^ todo.pop()) <= max_bits
            if near.any():
                found = rest[near]
                child.append(found)
                parent.append(np.full(len(found), root))
                todo.extend(found)
                rest = rest[~near]
    none = np.empty(0, np.uint64)
    return (np.concatenate(child), np.concatenate(parent)) if child else (none, none)


def _linker(max_bits: int, max_bucket: int):
    def batch_of(a, b, fixed, key):
        return pa.RecordBatch.from_arrays([pa.array(x.astype(np.uint64, copy=False).view(np.int64)) for x in (a, b)]
                                          + [pa.array(fixed, pa.int64()), pa.array(key, pa.int64())], schema=_EDGES)

    def link(batches):
        """Rows sorted by (mask, key).  Yields links, and the rows of overfull keys with mask and key set."""
        held: list[np.ndarray] = []  # of the key that may go on in the next batch
        at, n, over = None, 0, False

        def close():
            if n > 1 and not over:
                a, b = forest(np.concatenate(held), max_bits)
                if len(a):
                    yield batch_of(a, b, [None] * len(a), [None] * len(a))

        for batch in batches:
            if not batch.num_rows:
                continue
            mask, key, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            fp = fp.view(np.uint64)
            cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
            first, last = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(fp)]])
            inner = slice(1, -1) if len(first) > 2 else slice(0, 0)  # keys that begin and end in this batch
            twos = first[inner][(last - first)[inner] == 2]
            close_by = twos[np.bitwise_count(fp[twos] ^ fp[twos + 1]) <= max_bits] if len(twos) else twos
            a, b = [np.maximum(fp[close_by], fp[close_by + 1])], [np.minimum(fp[close_by], fp[close_by + 1])]
            for i in np.flatnonzero((last - first)[inner] > 2) + inner.start:
                if last[i] - first[i] <= max_bucket:
                    x, y = forest(fp[first[i]:last[i]], max_bits)
                    a.append(x)
                    b.append(y)
                else:
                    rows = fp[first[i]:last[i]]
                    yield batch_of(rows, rows, mask[first[i]:last[i]], key[first[i]:last[i]])
            a, b = np.concatenate(a), np.concatenate(b)
            if len(a):
                yield batch_of(a, b, [None] * len(a), [None] * len(a))
            for i in dict.fromkeys((0, len(first) - 1)):  # the first may continue what is held, the last may go on
                here = (int(mask[first[i]]), int(key[first[i]]))
                if here != at:
                    yield from close()
                    at, held, n, over = here, [], 0, False
                held.append(fp[first[i]:last[i]].copy())
                n += int(last[i] - first[i])
                if n > max_bucket or over:
                    over = True
                    rows, held = np.concatenate(held), []
                    yield batch_of(rows, rows, np.full(len(rows), here[0]), np.full(len(rows), here[1]))
        yield from close()

    return link


def links(fps: DataFrame, max_bits: int, blocks: int, max_bucket: int = 1 << 16) -> DataFrame:
    """``a, b``: a spanning forest, key by key, of all pairs of distinct ``fp`` at most ``max_bits`` bits apart."""
    masks = _masks((1 << 64) - 1, blocks, blocks - max_bits)
    todo = fps.select(F.explode(F.array(*(F.struct(F.lit(_signed(m)).alias("mask"),
                                                   F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                                          for m in masks))).alias("k"), "fp").select("k.mask", "k.key", "fp")
    found = None
    while True:
        dealt = todo.repartition("mask", "key").sortWithinPartitions("mask", "key")
        out = stored(map_arrow(dealt, _linker(max_bits, max_bucket), "a long, b long, fixed long, key long"), "links")
        pairs = out.filter("fixed is null").select("a", "b")
        found = pairs if found is None else found.union(pairs)
        over = out.filter("fixed is not null")
        fixed = [r[0] for r in over.select("fixed").distinct().collect()]  # masks: few, whatever the input
        if not fixed:
            return found
        # deal overfull keys again: of the free bits, one of (max_bits + 1) blocks must agree too
        finer = []
        for m in fixed:
            free = ~m & ((1 << 64) - 1)
            if free.bit_count() < max_bits + 1:
                raise ValueError("max_bucket is below the number of fingerprints that differ in so few bits")
            finer += [(m, _signed((m | x) & ((1 << 64) - 1))) for x in _masks(free, max_bits + 1, 1)]
        masks_of = fps.sparkSession.createDataFrame(finer, "fixed long, mask long")
        todo = (over.join(F.broadcast(masks_of), "fixed").select("mask", F.col("a").alias("fp")).distinct()
                .select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"))


def _labelled(rows: DataFrame, max_bits: int, blocks: int) -> DataFrame:
    """``fp, root`` for every distinct fingerprint of the stored ``rows``."""
    distinct = rows.select("fp").distinct()
    stars = components(links(distinct, max_bits, blocks))
    return distinct.join(stars, F.col("fp") == F.col("a"), "left").select("fp", F.coalesce("b", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    max_bits: int = 4, blocks: int = 7) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id."""
    rows = stored(docs.select(F.col(id_col).alias("doc_id"), fingerprint(docs, text_col, shingle).alias("fp")),
                  "fingerprints")
    lowest = rows.groupBy("fp").agg(F.min("doc_id").alias("low"))
    rooted = lowest.join(_labelled(rows, max_bits, blocks), "fp")
    by_root = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    labels = rooted.join(by_root, "root").select("fp", "component_id")
    return rows.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                         max_bits: int = 4, blocks: int = 7) -> DataFrame:
    """``docs`` with the row of the smallest id of each component (a NULL id only if there is no other)."""
    rows = stored(docs.withColumn(_FP, fingerprint(docs, text_col, shingle))
                  .withColumn(_ROW, F.monotonically_increasing_id()), "fingerprints")
    keys = rows.select(F.col(id_col).alias("id"), F.col(_FP).alias("fp"), F.col(_ROW).alias("row"))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    first = keys.groupBy("fp").agg(F.min(order).alias("first"))
    kept = (first.join(_labelled(keys, max_bits, blocks), "fp").groupBy("root").agg(F.min("first").alias("first"))
            .select(F.col("first.row").alias(_ROW)))
    return rows.join(kept, _ROW, "left_semi").select(*docs.columns)
