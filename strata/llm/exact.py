"""Exact duplicates through counting quotient filters and byte verification.

Each partition builds a counting quotient filter of its 64-bit fingerprints: the high bits (the quotient) name the run,
the low bits (the remainder) are kept sorted inside it with a count.  Filters of several partitions merge without loss
by merging the sorted remainders and adding the counts.  A filter is cut into blocks of neighbouring quotients, so
the merge is one small task per block, and a text that a third of the rows share is one entry per partition.
Fingerprints whose merged count is above one route their documents to verification, which compares the bytes
themselves; all other documents are unique.

Defined results: NULL text counts as empty; among equal texts the smallest id stays, a NULL id only if there is no other,
and of repeated rows with one id exactly one; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_arrow, stored

# White space that one space does not already equal: runs that start with a control character, runs of two or more.
_RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
_RUN_BITS = 6  # quotients per block: 64


def normalised(text: str | Column) -> Column:
    """The text with each run of white space as one space; NULL as empty."""
    return F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), _RUNS, " ")


class QuotientFilter:
    """A block of a counting quotient filter: run lengths by quotient, sorted remainders, counts."""

    def __init__(self, runs: np.ndarray, remainders: np.ndarray, counts: np.ndarray):
        self.runs, self.remainders, self.counts = runs, remainders, counts

    @staticmethod
    def bits(block_bits: int) -> np.uint64:
        """Bits of a remainder."""
        return np.uint64(64 - block_bits - _RUN_BITS)

    @classmethod
    def of_sorted(cls, fingerprints: np.ndarray, counts: np.ndarray, block_bits: int) -> QuotientFilter:
        """From the distinct fingerprints of one block, ascending."""
        low = cls.bits(block_bits)
        quotient = (fingerprints >> low) & np.uint64((1 << _RUN_BITS) - 1)
        runs = np.bincount(quotient.astype(np.int64), minlength=1 << _RUN_BITS)
        return cls(runs.astype("<u4"), (fingerprints & ((np.uint64(1) << low) - np.uint64(1))).astype("<u8"),
                   counts.astype("<u8"))

    def fingerprints(self, block: int, block_bits: int) -> np.ndarray:
        low = self.bits(block_bits)
        quotient = np.repeat(np.arange(1 << _RUN_BITS, dtype=np.uint64), self.runs)
        high = (np.uint64(block) << np.uint64(_RUN_BITS)) | quotient
        return (high << low) | self.remainders

    def to_bytes(self) -> bytes:
        return self.runs.tobytes() + self.remainders.tobytes() + self.counts.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> QuotientFilter:
        n = 1 << _RUN_BITS
        body = np.frombuffer(raw, dtype="<u8", offset=4 * n)
        half = len(body) // 2
        return cls(np.frombuffer(raw, dtype="<u4", count=n), body[:half], body[half:])

    @classmethod
    def merged(cls, filters: list[QuotientFilter], block: int, block_bits: int) -> QuotientFilter:
        """The filter of all rows that went into ``filters``: remainders merge in order, counts add up."""
        every = np.concatenate([f.fingerprints(block, block_bits) for f in filters])
        order = np.argsort(every, kind="stable")  # merges the runs, each sorted already
        distinct, first = np.unique(every[order], return_index=True)
        counts = np.add.reduceat(np.concatenate([f.counts for f in filters])[order], first) if len(first) else first
        return cls.of_sorted(distinct, counts, block_bits)


def repeated_fingerprints(rows: DataFrame, fingerprint: str) -> DataFrame:
    """Fingerprints (column ``fingerprint``, long) that more than one row has, once each."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block_bits = max(4, math.ceil(math.log2(4 * partitions)))

    def build(batches):
        parts = [b.column(0).to_numpy(zero_copy_only=False).view(np.uint64) for b in batches if b.num_rows]
        if not parts:
            return
        distinct, counts = np.unique(np.concatenate(parts), return_counts=True)
        block = (distinct >> np.uint64(64 - block_bits)).astype(np.int64)
        names, first = np.unique(block, return_index=True)
        cuts = [*first.tolist(), len(distinct)]
        yield pa.RecordBatch.from_arrays([
            pa.array(names.astype(np.int32)),
            pa.array([QuotientFilter.of_sorted(distinct[a:b], counts[a:b], block_bits).to_bytes()
                      for a, b in zip(cuts, cuts[1:])], pa.binary())], names=["block", "filter"])

    def merge(group):
        block = int(group["block"].iloc[0])
        all_rows = QuotientFilter.merged([QuotientFilter.from_bytes(x) for x in group["filter"]], block, block_bits)
        found = all_rows.fingerprints(block, block_bits)[all_rows.counts > 1].view(np.int64)
        return group.iloc[:0].assign(**{fingerprint: []}).drop(columns=["block", "filter"]).reindex(
            range(len(found))).assign(**{fingerprint: found})

    filters = map_arrow(rows.select(F.col(fingerprint).cast("long")), build, "block int, filter binary")
    return filters.groupBy("block").applyInPandas(merge, f"{fingerprint} long")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256."""
    texts = docs.select(F.col(id_col).alias("doc_id"), normalised(text_col).alias("text"))
    hashed = texts.select("doc_id", F.xxhash64("text").alias("fp"), F.sha2("text", 256).alias("sha"), "text")
    keyed = stored(hashed.select("doc_id", "fp", F.unhex("sha").alias("sha"),
                                 F.monotonically_increasing_id().alias("row")), "keyed")
    repeated = stored(repeated_fingerprints(keyed, "fp"), "repeated")
    # Byte verification of the routed documents: one group per digest, whose least and greatest bytes must agree.
    same = (hashed.join(repeated, "fp", "left_semi").groupBy("fp", F.unhex("sha").alias("sha"))
            .agg((F.min("text") == F.max("text")).alias("same")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    groups = (keyed.join(repeated, "fp", "left_semi").groupBy("fp", "sha")
              .agg(first.alias("first"), F.count("*").alias("n")).join(same, ["fp", "sha"])
              .select("fp", "sha", "first", F.when(F.col("same"), F.col("n")).otherwise(
                  F.raise_error(F.lit("texts differ under one SHA-256"))).alias("n")))
    # stored, so that the join has a plain shuffle on either side and Spark can split a large group's rows
    groups = stored(groups, "groups")
    return keyed.join(groups, ["fp", "sha"], "left").select(
        "doc_id", F.coalesce("first.doc_id", "doc_id").alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("first.row") == F.col("row"), F.lit(True)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))
