"""Phrase collocations per language: best-first growth of phrases from two to four words under score bounds.

A phrase of two to four words with at least ``least`` occurrences is a candidate.  Cut after its first k words it scores
``floor(2000000 * a / (l + r))`` of its own count a and the counts l and r of the two parts; its lowest-scoring cut holds.
A candidate whose words lie inside a longer one that has at least four fifths of its occurrences is dropped.  The best
``limit`` of each language are returned.

Words and then pairs of words are counted first; what occurs ``least`` times is the frontier.  The count c of a prefix bounds
every phrase that starts with it: a is at most c and the rest occurs at least a times, so the cut after the first
word, which occurs f times, scores at most ``2000000 * c / (f + c)``.  Each language has a score to settle at, first that of a
pair as far down as ``2 * limit``.  Only prefixes whose bound reaches that score are grown, and only neighbours of phrases that
reach it are counted to see what they are dropped for (one word more is enough: any longer candidate holds one that
is one word longer and at least as frequent).  Where fewer than ``limit`` phrases that reach it survive, the score is lowered and
the frontier expanded, down to 0 if need be; then the best ``limit`` and all ties are settled.

Texts are scanned anew for every length, whole, and counted per task before anything is shuffled.  A gate of a
fixed size in every task tells which windows of words may count: flags by 64-bit hash.  Two phrases on one flag let a window
through that is not needed; counts of phrases go by their text, so that never changes a result.

Defined results: NULL text is empty; NULL language is ``und``; ids are not read; repeated rows count as often as they
occur; a language with no candidate, and an empty table, give no rows; words of any length are whole words.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import map_arrow, ship, stored

LONGEST = 4
# What separates pieces, and what separates words in a piece.
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_TOKENS = re.compile(rb"[^\x20\x09.,;:!?\x0A-\x0D]+").findall
_AT_BREAK = re.compile(rb"[.,;:!?\x0A-\x0D]").search
_CHUNK = 1 << 20  # bytes of text in work at a time; cut at a break only
_HELD = 400_000  # counts a task holds before it hands them on
_ROWS = 50_000  # rows of an Arrow batch handed on
_MULTIPLIERS = tuple(np.uint64(xxhash.xxh64_intdigest(b"place", seed=i) | 1) for i in range(LONGEST))
_MIX = np.uint64(xxhash.xxh64_intdigest(b"mix", seed=0) | 1)
SUPPORTED, GROWS, REACHES = 1, 2, 4  # flags of a phrase


_SPACE, _BREAK = 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _SPACE
_KIND[list(_BREAKS)] = _BREAK


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier and of its inverse, modulo 2 ** 64."""
    base, out = int(_MULTIPLIERS[0]), []
    for x in (base, pow(base, -1, 1 << 64)):
        powers = np.full(n, x, np.uint64)
        powers[0] = 1
        out.append(np.cumprod(powers, out=powers))
    return tuple(out)


class Words:
    """The words of a run of text by where they start and end, a break between pieces as a word with the hash 0.

    A word's hash is the sum of its bytes times powers of a multiplier, modulo 2 ** 64, out of running sums.
    """

    def __init__(self, lang: str, run: bytes):
        self.raw = run
        kind = _KIND[np.frombuffer(run, np.uint8)]
        inside = np.concatenate([[False], kind == 0, [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edges[::2], edges[1::2]
        n = len(run)
        forth, back = _powers(1 << max(n, _CHUNK).bit_length())
        sums = np.concatenate([[np.uint64(0)], np.cumsum((np.frombuffer(run, np.uint8).astype(np.uint64) + np.uint64(1))
                                                         * forth[:n])])
        value = (sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64) * _MIX
        value ^= np.uint64(xxhash.xxh64_intdigest(lang.encode()))
        value *= _MIX
        value ^= value >> np.uint64(32)
        value *= _MULTIPLIERS[1]
        value[value == 0] = 1
        # a break stands where one lies between a word and the word before
        breaks = np.concatenate([[0], np.cumsum(kind == _BREAK)])
        parted = np.flatnonzero(breaks[start[1:]] != breaks[end[:-1]]) + 1
        self.start = np.insert(start, parted, 0)
        self.end = np.insert(end, parted, 0)
        self.hashes = np.insert(value, parted, np.uint64(0))
        self.next_to = (self.start[1:] - self.end[:-1] == 1)

    def phrases(self, at: np.ndarray, k: int) -> list[bytes]:
        """The windows of ``k`` words at ``at``, one space between words."""
        near = np.logical_and.reduce([self.next_to[at + j] for j in range(k - 1)]) if k > 1 else np.ones(len(at), bool)
        raw, out = self.raw, []
        for i, x, y, plain in zip(at.tolist(), self.start[at].tolist(), self.end[at + k - 1].tolist(), near.tolist()):
            phrase = raw[x:y]
            if not plain or b"\t" in phrase:
                phrase = b" ".join(raw[self.start[i + j]:self.end[i + j]] for j in range(k))
            out.append(phrase)
        return out


def codes_of(hashes: np.ndarray, k: int) -> np.ndarray:
    """One 64-bit code for every window of ``k`` words (a single word's is its hash)."""
    if k == 1:
        return hashes
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = sum(hashes[j:j + n] * _MULTIPLIERS[j] for j in range(k))
    return (total ^ (total >> np.uint64(31))) * _MIX


class Gate:
    """Flags by the first bits of a code."""

    def __init__(self, flags: np.ndarray):
        self.flags, self.shift = flags, np.uint64(64 - (len(flags).bit_length() - 1))

    def has(self, codes: np.ndarray, flag: int) -> np.ndarray:
        return (self.flags[(codes >> self.shift).astype(np.int64)] & flag) != 0


def _chunks(texts: list[bytes]):
    """The texts joined at breaks, in runs of about ``_CHUNK`` bytes."""
    run, size = [], 0
    for text in texts:
        at = 0
        while len(text) - at > _CHUNK:
            cut = _AT_BREAK(text, at + _CHUNK)
            if cut is None:
                break
            yield text[at:cut.start()]
            at = cut.start()
        run.append(text[at:])
        size += len(text) - at
        if size >= _CHUNK:
            yield b"\n".join(run)
            run, size = [], 0
    if run:
        yield b"\n".join(run)


def _runs(batches):
    """(language, run of text in lower case)."""
    for batch in batches:
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("raw").to_pylist()):
            by_lang.setdefault(lang, []).append(text.lower())  # of bytes: A to Z only
        for lang, texts in by_lang.items():
            for run in _chunks(texts):
                yield lang, run


def _whole(hashes: np.ndarray, k: int) -> np.ndarray:
    """Windows of ``k`` words without a break among them."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, bool)
    word = hashes != 0
    return np.logical_and.reduce([word[j:j + n] for j in range(k)])


def _texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("raw"))


def _count_phrases(texts: DataFrame, k: int, wanted) -> DataFrame:
    """(lang, phrase, n) of the windows of ``k`` words that ``wanted`` (hashes -> mask over the windows) accepts; without
    it, of all single words."""
    def run(batches):
        held: dict[str, Counter] = {}

        def written():
            for lang, counts in held.items():
                rows = iter(counts.items())
                while some := list(itertools.islice(rows, _ROWS)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(some), pa.string()), pa.array([p for p, _ in some], pa.binary()),
                         pa.array([n for _, n in some], pa.int64())], names=["lang", "phrase", "n"])
            held.clear()

        for lang, run in _runs(batches):
            counts = held.setdefault(lang, Counter())
            if wanted is None:
                counts.update(_TOKENS(run))
            else:
                words = Words(lang, run)
                if len(words.hashes) >= k:
                    counts.update(words.phrases(np.flatnonzero(_whole(words.hashes, k) & wanted(words.hashes)), k))
            if sum(map(len, held.values())) >= _HELD:
                yield from written()
        yield from written()

    counted = map_arrow(texts, run, "lang string, phrase binary, n long")
    return counted.groupBy("lang", F.col("phrase").cast("string").alias("phrase")).agg(F.sum("n").alias("n"))


def _supported_pairs(texts: DataFrame, words: Gate, least: int) -> DataFrame:
    """(code, n) of pairs of frequent words; codes that two pairs share have the sum of both."""
    def run(batches):
        held, size = [], 0

        def written():
            values, times = np.unique(np.concatenate(held), return_counts=True)
            for at in range(0, len(values), _ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(values[at:at + _ROWS].view(np.int64)),
                                                  pa.array(times[at:at + _ROWS])], names=["code", "n"])

        for lang, text in _runs(batches):
            hashes = Words(lang, text).hashes
            if len(hashes) < 2:
                continue
            frequent = words.has(hashes, SUPPORTED) & (hashes != 0)
            codes = codes_of(hashes, 2)[frequent[:-1] & frequent[1:]]
            held.append(codes)
            size += len(codes)
            if size >= 2_000_000:
                yield from written()
                held, size = [], 0
        if held:
            yield from written()

    counted = map_arrow(texts, run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= least)


def _with_codes(phrases: DataFrame) -> DataFrame:
    """``phrases`` (lang, phrase, ...) with the ``code`` of each."""
    ship(phrases.sparkSession)

    @F.pandas_udf("long")
    def code(lang: pd.Series, phrase: pd.Series) -> pd.Series:
        out = []
        for x, p in zip(lang, phrase):
            hashes = Words(x, p.encode()).hashes
            out.append(codes_of(hashes, len(hashes)).view(np.int64)[0])
        return pd.Series(out, dtype="int64")

    return phrases.withColumn("code", code("lang", "phrase"))


def _gate(coded: DataFrame, bits: int) -> Gate:
    """Flags (column ``flags``) by code: 2 ** bits bytes, eight to a row on their way to the driver."""
    slot = F.shiftrightunsigned(F.col("code"), 64 - bits)
    packed = coded.groupBy(F.shiftright(slot, 3).alias("at")).agg(
        F.expr(f"bit_or(shiftleft(cast(flags as bigint), cast((shiftrightunsigned(code, {64 - bits}) & 7) * 8 as int)))")
        .alias("octet")).toArrow()
    flags = np.zeros(1 << bits, np.uint8)
    flags.view("<i8")[packed["at"].to_numpy()] = packed["octet"].to_numpy()
    return Gate(flags)


def _floor_ratio(a: str, below: str) -> str:
    """``floor(2000000 * a / below)`` in exact arithmetic; the product may pass 64 bits."""
    return f"(cast(2000000 as decimal(7,0)) * cast({a} as decimal(20,0))) div cast({below} as decimal(20,0))"


def _scored(phrases: DataFrame, counts: DataFrame, k: int) -> DataFrame:
    """lang, phrase, a, first (count of the first word), l, r, score of phrases of ``k`` words.

    ``counts`` (lang, phrase, n) holds every part; each part of each cut is one join.
    """
    words = F.split("phrase", " ")
    cuts = phrases.select("lang", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.lit(k - 1))).alias("cut")) \
        .select("lang", "phrase", "a", "cut", F.array_join(F.slice(words, F.lit(1), F.col("cut")), " ").alias("left_part"),
                F.array_join(F.slice(words, F.col("cut") + 1, F.lit(k)), " ").alias("right_part"))
    left = counts.select("lang", F.col("phrase").alias("left_part"), F.col("n").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right_part"), F.col("n").alias("r"))
    both = cuts.join(left, ["lang", "left_part"]).join(right, ["lang", "right_part"])
    both = both.withColumn("score", F.expr(_floor_ratio("a", "l + r")))
    # the lowest score, then the smallest cut
    best = both.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("best"), F.first("a").alias("a"),
        F.max(F.when(F.col("cut") == 1, F.col("l"))).alias("first"))
    return best.select("lang", "phrase", "a", "first", "best.l", "best.r", "best.score")


def _flagged(scored: DataFrame, goals: DataFrame) -> DataFrame:
    """Phrases with their code and flags against the score their language is to settle at (settled ones have none)."""
    bound = F.expr(_floor_ratio("a", "first + a"))
    reaches = F.col("score") >= F.col("goal")
    # every language of a phrase is in goals, one row for each
    at = scored.join(goals.select("lang", "goal"), "lang")
    flags = (F.lit(SUPPORTED) + F.when(reaches | (bound >= F.col("goal")), GROWS).otherwise(0)
             + F.when(reaches, REACHES).otherwise(0))
    return _with_codes(at.select("lang", "phrase", flags.alias("flags"))).select("code", "flags")


def _survivors(scored: DataFrame, longer: DataFrame) -> DataFrame:
    """``scored`` without phrases inside a phrase, one word longer, with at least four fifths of their occurrences."""
    words = F.split("phrase", " ")
    inside = longer.select("lang", "n", F.explode(F.array(
        F.array_join(F.slice(words, F.lit(1), F.size(words) - 1), " "),
        F.array_join(F.slice(words, F.lit(2), F.size(words) - 1), " "))).alias("phrase"))
    most = inside.groupBy("lang", "phrase").agg(F.max("n").alias("within"))
    kept = scored.join(most, ["lang", "phrase"], "left")
    return kept.filter(F.col("within").isNull() | (F.col("within") * 100 < F.col("a") * 80)).drop("within")


def _goal_at(pairs: DataFrame, langs: DataFrame, place: int | None) -> DataFrame:
    """(lang, goal): the score of the pair at ``place`` of its language; 0 where there are fewer, or without a place."""
    if place is None:
        return langs.select("lang", F.lit(0).cast("long").alias("goal"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), "phrase")
    at = pairs.select("lang", "score", "phrase").withColumn("nth", F.row_number().over(order)) \
        .filter(F.col("nth") <= place).groupBy("lang").agg(F.max("nth").alias("nth"), F.min("score").alias("least"))
    goal = F.when(F.col("nth") == place, F.col("least")).otherwise(0).cast("long")
    return langs.join(at, "lang", "left").select("lang", F.coalesce(goal, F.lit(0)).alias("goal"))


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 30, limit: int = 2000,
                 gate_bits: int = 23) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best ``limit`` surviving phrases of each language.

    Order: score, then a, both descending, then the phrase in byte order.  A gate takes 2 ** ``gate_bits`` bytes in every task.
    """
    texts = _texts(docs, lang_col, text_col)
    every = stored(_count_phrases(texts, 1, None), "words")
    totals = stored(every.groupBy("lang").agg(F.sum("n").alias("total")), "totals")
    words = stored(every.filter(F.col("n") >= least), "frequent")
    word_gate = _gate(_with_codes(words).select("code", F.lit(SUPPORTED).alias("flags")), gate_bits)
    supported = stored(_supported_pairs(texts, word_gate, least), "pairs")
    pair_gate = _gate(supported.select("code", F.lit(SUPPORTED).alias("flags")), gate_bits)
    twos = stored(_count_phrases(texts, 2, lambda hashes: pair_gate.has(codes_of(hashes, 2), SUPPORTED))
                  .filter(F.col("n") >= least), "twos")
    scored2 = stored(_scored(twos, words, 2), "scored2")

    open_langs, done = totals.select("lang"), []
    for place in (2 * limit, 8 * limit, None):
        goals = stored(_goal_at(scored2, open_langs, place), "goals")
        found = _expand(texts, words, twos, scored2, goals, least, gate_bits)
        settled = stored(goals.join(found.groupBy("lang").count(), "lang", "left")
                         .select("lang", ((F.coalesce("count", F.lit(0)) >= limit) | (F.col("goal") == 0)).alias("settled")),
                         "settled")
        done.append(found.join(settled.filter("settled").select("lang"), "lang"))
        open_langs = settled.filter("not settled").select("lang")
        if open_langs.isEmpty():
            break
    best = done[0]
    for more in done[1:]:
        best = best.unionByName(more)
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                              F.col("total").alias("n"), "score")


def _expand(texts: DataFrame, words: DataFrame, twos: DataFrame, scored2: DataFrame, goals: DataFrame, least: int,
            bits: int) -> DataFrame:
    """Survivors that reach the goal of their language (languages without a goal take no part)."""
    two = _gate(_flagged(scored2, goals), bits)

    def threes_wanted(hashes):
        pairs = codes_of(hashes, 2)
        ok, grows, reaches = two.has(pairs, SUPPORTED), two.has(pairs, GROWS), two.has(pairs, REACHES)
        return ok[:-1] & ok[1:] & (grows[:-1] | reaches[1:])

    threes = stored(_count_phrases(texts, 3, threes_wanted).filter(F.col("n") >= least), "threes")
    parts = words.unionByName(twos)
    scored3 = stored(_scored(threes, parts, 3), "scored3")
    three = _gate(_flagged(scored3, goals), bits)

    def fours_wanted(hashes):
        ok, triples = two.has(codes_of(hashes, 2), SUPPORTED), codes_of(hashes, 3)
        grows, reaches = three.has(triples, GROWS), three.has(triples, REACHES)
        return ok[:-2] & ok[1:-1] & ok[2:] & (grows[:-1] | reaches[1:])

    fours = stored(_count_phrases(texts, 4, fours_wanted).filter(F.col("n") >= least), "fours")
    # last three words whose own prefix was not grown: counted for the cut after the first word
    rest = F.array_join(F.slice(F.split("phrase", " "), F.lit(2), F.lit(3)), " ")
    missing = stored(fours.select("lang", rest.alias("phrase")).distinct().join(threes, ["lang", "phrase"], "left_anti"),
                     "missing")
    if not missing.isEmpty():
        gate = _gate(_with_codes(missing).select("code", F.lit(SUPPORTED).alias("flags")), bits)
        more = _count_phrases(texts, 3, lambda hashes: gate.has(codes_of(hashes, 3), SUPPORTED)) \
            .join(missing, ["lang", "phrase"], "left_semi")
        threes = stored(threes.unionByName(more), "all_threes")
        scored3 = stored(_scored(threes, parts, 3), "all_scored3")
    scored4 = _scored(fours, parts.unionByName(threes), 4)
    every = scored2.unionByName(scored3).unionByName(scored4).join(goals, "lang") \
        .filter(F.col("score") >= F.col("goal")).drop("goal")
    return stored(_survivors(every, threes.unionByName(fours)), "survivors")
