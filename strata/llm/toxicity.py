"""Toxicity: a support vector machine over a subsequence string kernel, with Nyström landmarks.

A text is a bag of sentences, a sentence a set of units: its words in lower case, and runs of single
characters joined ("i d i o t"), letters and digits only.  The kernel of two units is the mean, over lengths 2 and 3, of the
normalised count of common subsequences, a gap of g characters weighing ``DECAY ** g``.  An insult with gaps or inserted characters therefore stays close
to the plain one.  A unit's kernels with a fixed number of landmark units, whitened by the landmarks' own kernel
matrix (Nyström), are its features.  A sentence's features are
the sum of its units', so its margin is a sum as well, and each unit's part is worked out once in a worker.

Training reads labelled texts, a bounded sample of them (``max_labelled``, by id hash); copies count once.  Landmarks are the
units that tell the classes apart best, and as many drawn by hash.  Every sentence has its text's label to begin with; then, in
rounds, a toxic text is stood for by the sentence that the machine finds most toxic, and a clean one by those it finds most
toxic.  Each fit is a squared-hinge machine solved by Newton steps, whose sums (of a fixed size) Spark adds up over partitions.
A text's score is a logistic function of its highest sentence margins, of the share of its sentences beyond zero and of its
highest words, fitted on texts kept out of the machine.

Units of more than 20 characters are read as windows of 20 that start every 10, so long strings are read whole at a cost
that grows with their length only.  Defined results: NULL and empty texts are scored like any text without units; rows with a NULL
label or id are not learned from; without both labels every score is 0; repeated rows are scored each; an empty table
gives no rows; only the named columns are read.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_arrow, stored
from strata.llm.language import remainder

LENGTHS, DECAY = (2, 3), 0.6
_WIDE, _STEP = 20, 10
_SENTENCES = re.compile(r"[.!?;\n\r]+(?=\s|$)|[\n\r]+").split
_KEPT_UNITS = 600_000
_GROUP = 1_000_000  # characters of texts whose new units are worked out together
_TOP = 3  # margins of a text that its score sees


# ------------------------------------------------------------------ units
def units_of(sentence: str) -> list[str]:
    """The different words, as their letters and digits after a mark for the start; runs of three and more single
    characters are one word; long ones in windows."""
    words, run = [], []
    for word in sentence.lower().split():
        if not word.isalnum():
            word = "".join(filter(str.isalnum, word))
        if len(word) == 1:
            run.append(word)
            continue
        if run:
            if len(run) > 2:
                words.append("".join(run))
            run = []
        words.append(word)
    if len(run) > 2:
        words.append("".join(run))
    out = []
    for word in dict.fromkeys(words):
        if word:
            marked = "^" + word
            out += [marked] if len(marked) <= _WIDE else [
                marked[i:i + _WIDE] for i in range(0, len(marked) - _STEP, _STEP)]
    return out


def sentences_of(text: str | None) -> list[list[str]]:
    """Units of each sentence that has any."""
    return [u for u in map(units_of, _SENTENCES(text or "")) if u]


# ------------------------------------------------------------------ kernel
_PLACES = tuple(np.uint64(xxhash.xxh64_intdigest(b"place", seed=i) | 1) for i in range(max(LENGTHS)))


@functools.lru_cache(maxsize=4 * _WIDE)
def _choices(width: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The ways to choose ``length`` places of ``width`` in order, and the weight of each."""
    places = np.array(list(itertools.combinations(range(width), length)), np.int64).reshape(-1, length)
    return places, (DECAY ** (places[:, -1] - places[:, 0] - (length - 1))).astype(np.float32)


def _characters(units: list[str]) -> np.ndarray:
    """Code points of units of one length, a row each."""
    return np.frombuffer("".join(units).encode("utf-32-le"), "<u4").reshape(len(units), -1).astype(np.uint64)


def _subsequences(rows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit code for each subsequence of each unit (a row of codes each), and their weights."""
    places, weights = _choices(rows.shape[1], length)
    codes = np.full((len(rows), len(places)), np.uint64(length))
    for j in range(length):
        codes += (rows[:, places[:, j]] + np.uint64(1)) * _PLACES[j]
    codes ^= codes >> np.uint64(29)
    codes *= _PLACES[0]
    return codes, weights


def _norms(rows: np.ndarray) -> np.ndarray:
    """Lengths of the units' vectors of gap-weighted subsequences: shape (len(LENGTHS), units).

    For each length, ``ends`` sums over pairs of equal subsequences by the places where they end; what ends before,
    decayed by the characters between, is one triangular matrix product along either copy.
    """
    n, width = rows.shape
    gap = np.subtract.outer(np.arange(width), np.arange(width)) - 1
    before = np.where(gap >= 0, DECAY ** np.maximum(gap, 0), 0).astype(np.float32)
    same = (rows.T[:, None] == rows.T[None, :]).astype(np.float32)
    ends, out = same, []
    for length in range(1, max(LENGTHS) + 1):
        if length > 1:
            tail = (before @ ends.reshape(width, width * n)).reshape(width, width, n)
            ends = same * np.matmul(before, tail)
        if length in LENGTHS:
            out.append(np.sqrt(np.maximum(ends.sum(axis=(0, 1)), 0)))
    return np.array(out)


class Landmarks:
    """Per length: the codes of all subsequences of the landmarks, and for each code a row over the landmarks."""

    def __init__(self, units: list[str]):
        self.units, self.codes, self.rows = units, [], []
        norms = np.hstack([_norms(_characters([u])) for u in units]) if units else np.zeros((len(LENGTHS), 0))
        lengths = np.maximum((norms > 0).sum(axis=0), 1)  # a length that a landmark is too short for does not count
        for k, length in enumerate(LENGTHS):
            found: dict[int, dict[int, float]] = {}
            for j, unit in enumerate(units):
                codes, weights = _subsequences(_characters([unit]), length)
                for code, weight in zip(codes[0].tolist(), weights.tolist()):
                    row = found.setdefault(code, {})
                    row[j] = row.get(j, 0.0) + weight / float(norms[k, j] * lengths[j])
            self.codes.append(np.array(sorted(found), np.uint64))
            rows = np.zeros((len(found), len(units)), np.float32)
            for i, code in enumerate(self.codes[-1].tolist()):
                for j, value in found[code].items():
                    rows[i, j] = value
            self.rows.append(rows)

    def weighed(self, weights: np.ndarray) -> "Weights":
        """The kernels' combination with ``weights`` (landmarks, columns): a row of columns for each code."""
        return Weights(self.codes, [r @ weights.astype(np.float32) for r in self.rows])


class Weights:
    """What a unit's subsequences add up to: for each code of ``codes`` (per length) its row of ``rows``."""

    def __init__(self, codes: list[np.ndarray], rows: list[np.ndarray]):
        self.codes, self.rows = codes, rows
        self.seen, self.first = [], []
        for c in codes:  # by the first bits of a code: whether any is known, and the place of the first
            bits = (c >> np.uint64(44)).astype(np.int64)
            seen, first = np.zeros(1 << 20, bool), np.zeros(1 << 20, np.int32)
            seen[bits] = True
            first[bits[::-1]] = np.arange(len(c), dtype=np.int32)[::-1]
            self.seen.append(seen)
            self.first.append(first)

    def of(self, units: list[str]) -> np.ndarray:
        """A row of columns for each unit: the sum over its subsequences, normalised per length."""
        out = np.zeros((len(units), self.rows[0].shape[1]), np.float32)
        by_length: dict[int, list[int]] = {}
        for i, u in enumerate(units):
            by_length.setdefault(len(u), []).append(i)
        for width, places in by_length.items():
            if width < min(LENGTHS):
                continue
            step = max(1, min(1024, 400_000 // max(1, len(_choices(width, max(LENGTHS))[0]))))
            for at in range(0, len(places), step):
                some = places[at:at + step]
                rows = _characters([units[i] for i in some])
                norms = _norms(rows)
                for k, length in enumerate(LENGTHS):
                    if width >= length and len(self.codes[k]):
                        out[some] += self._sums(k, rows, length) / norms[k][:, None]
        return out

    def _sums(self, k: int, rows: np.ndarray, length: int) -> np.ndarray:
        codes, weights = _subsequences(rows, length)
        bits = (codes >> np.uint64(44)).astype(np.int64)
        unit, place = np.nonzero(self.seen[k][bits])
        codes, at = codes[unit, place], self.first[k][bits[unit, place]]
        other = np.flatnonzero(self.codes[k][at] != codes)  # unknown, or not the first with these bits
        at[other] = np.minimum(np.searchsorted(self.codes[k], codes[other]), len(self.codes[k]) - 1)
        hit = self.codes[k][at] == codes
        unit, at, weight = unit[hit], at[hit], weights[place[hit]]
        columns = self.rows[k].shape[1]
        if columns == 1:
            return np.bincount(unit, weight * self.rows[k][at, 0], minlength=len(rows))[:, None].astype(np.float32)
        out = np.zeros((len(rows), columns), np.float32)
        if len(unit):
            starts = np.flatnonzero(np.diff(unit, prepend=-1))
            out[unit[starts]] = np.add.reduceat(self.rows[k][at] * weight[:, None], starts, axis=0)
        return out


def kernel(units: list[str], landmarks: list[str]) -> np.ndarray:
    """Kernels of units with landmarks."""
    return Landmarks(landmarks).weighed(np.eye(len(landmarks))).of(units)


# ------------------------------------------------------------------ model
@dataclass
class Model:
    landmarks: Landmarks
    whiten: np.ndarray  # inverse square root of the landmarks' kernel matrix
    weights: np.ndarray  # of the whitened features, then the offset
    scale: np.ndarray  # logistic function of what ``summary`` gives, then the offset

    def __post_init__(self):
        self._parts = self.landmarks.weighed((self.whiten @ self.weights[:-1])[:, None])
        self._known: dict[str, float] = {}
        self._older: dict[str, float] = {}

    def __getstate__(self):
        """For the workers: what scoring needs, which does not hold a row over all landmarks for each code."""
        return {"weights": self.weights, "scale": self.scale, "_parts": self._parts, "_known": {}, "_older": {}}

    def remember(self, units) -> None:
        """Each unit's part of a margin, kept in two bounded generations: when the young one is full it is the old one."""
        units = set(units)
        if len(self._known) + len(units) > _KEPT_UNITS:
            self._older, self._known = self._known, {}
        new = [u for u in units if u not in self._known]
        again = [u for u in new if u in self._older]
        self._known.update(zip(again, map(self._older.__getitem__, again)))
        fresh = [u for u in new if u not in self._older]
        self._known.update(zip(fresh, self._parts.of(fresh)[:, 0].tolist()))

    def summaries(self, texts: list[str | None]) -> list[np.ndarray]:
        """Of each text: its highest sentence margins, the share of its sentences beyond zero, its highest words."""
        out, group, size = [], [], 0
        for i, text in enumerate(texts):
            group.append(sentences_of(text))
            size += len(text or "")
            if size >= _GROUP or i == len(texts) - 1:
                units = [set(itertools.chain.from_iterable(sentences)) for sentences in group]
                self.remember(set().union(*units))
                out += map(self._summary, group, units)
                group, size = [], 0
        return out

    def _summary(self, sentences: list[list[str]], units: set[str]) -> np.ndarray:
        part = self._known.__getitem__
        margins = np.array([sum(map(part, s)) for s in sentences]) + self.weights[-1]
        shares = [float((margins > 0).mean()) if len(margins) else 0.0]
        return np.concatenate([_highest(margins), shares, _highest(np.array([part(u) for u in units]))])

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        z = np.array(self.summaries(texts)) @ self.scale[:-1] + self.scale[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _highest(values: np.ndarray) -> np.ndarray:
    """The ``_TOP`` highest, within -2 and 4; -2 where there are fewer."""
    top = np.clip(np.sort(values)[::-1][:_TOP], -2, 4)
    return np.concatenate([top, np.full(_TOP - len(top), -2.0)])


def _landmarks(units: DataFrame, many: int) -> list[str]:
    """Units of (unit, doc_id, label): half those that tell toxic texts best from clean ones, half drawn by hash."""
    counts = units.groupBy("unit").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
    total = units.select("doc_id", "label").distinct().agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c")).first()
    t, c = float(total["t"] or 0) + 1, float(total["c"] or 0) + 1
    # difference of the shares over its spread if both classes were alike
    mean = (F.col("toxic") + F.col("clean")) / (t + c)
    told = (F.col("toxic") / t - F.col("clean") / c) / F.sqrt(mean * (1 / t + 1 / c) + 1e-9)
    frequent = counts.filter((F.col("toxic") + F.col("clean") >= 2) & (F.length("unit") > 2) & (F.length("unit") <= _STEP))
    best = frequent.orderBy(told.desc(), "unit").limit(many // 2).select("unit")
    drawn = frequent.orderBy(F.xxhash64("unit"), "unit").limit(many // 2).select("unit")
    return sorted({r["unit"] for r in best.union(drawn).collect()})


def _newton(rows: DataFrame, size: int, ridge: float, start: np.ndarray, steps: int = 8) -> np.ndarray:
    """Squared-hinge machine over (features binary, label -1 or 1, weight): Newton steps; each partition sums its part of
    the system (of a fixed size, and a fixed number of partitions), and the driver adds the parts and solves it."""
    w = start
    for _ in range(steps):
        now = w

        def sums(batches):
            total = np.zeros((size + 1, size + 2))
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = np.frombuffer(b"".join(batch.column("features").to_pylist()), "<f4").reshape(-1, size)
                x = np.hstack([x, np.ones((len(x), 1), np.float32)]).astype(np.float64)
                y = batch.column("label").to_numpy(zero_copy_only=False)
                weight = batch.column("weight").to_numpy(zero_copy_only=False)
                active = y * (x @ now) < 1
                x, y, weight = x[active], y[active], weight[active]
                total += x.T @ np.hstack([x * weight[:, None], (y * weight)[:, None]])
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

        parts = map_arrow(rows, sums, "total binary").collect()
        total = np.sum([np.frombuffer(r["total"]).reshape(size + 1, size + 2) for r in parts], axis=0)
        penalty = np.eye(size + 1) * ridge
        penalty[-1, -1] = 1e-8
        w = np.linalg.solve(total[:, :-1] + penalty, total[:, -1])
        if np.abs(w - now).max() < 1e-3:
            break
    return w


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Logistic regression of a few numbers by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w)), grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(labelled: DataFrame, landmarks: int = 192, rounds: int = 3, ridge: float = 0.05, parts: int = 12) -> Model | None:
    """From rows (doc_id, text, label 0 or 1, calibrate): the machine on the rows that aren't, the scale on those that are."""
    spark = labelled.sparkSession

    def spelled(batches):
        for batch in batches:
            for doc_id, text, label in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "label"))):
                seen = Counter(u for s in sentences_of(text) for u in set(s))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(seen), pa.string()), pa.array([doc_id] * len(seen), pa.string()),
                     pa.array([label] * len(seen), pa.float64())], names=["unit", "doc_id", "label"])

    rows = stored(labelled.withColumn("doc_id", F.col("doc_id").cast("string")).repartition(parts), "labelled")
    fit, check = rows.filter(~F.col("calibrate")), rows.filter("calibrate")
    if fit.select("label").distinct().count() < 2:
        return None
    names = _landmarks(map_arrow(fit, spelled, "unit string, doc_id string, label double"), landmarks)
    marks = Landmarks(names)
    gram = marks.weighed(np.eye(len(names))).of(names).astype(np.float64)
    gram = (gram + gram.T) / 2
    values, vectors = np.linalg.eigh(gram)
    keep = values > 1e-3
    whiten = (vectors[:, keep] / np.sqrt(values[keep])).astype(np.float32)
    size = int(keep.sum())
    features = marks.weighed(whiten)

    def featured(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                some = [(d, y, s) for d, t, y in zip(*(batch.column(c)[at:at + 100].to_pylist() for c in ("doc_id", "text", "label")))
                        for s in {tuple(s): s for s in sentences_of(t)}.values()]
                place = {u: i for i, u in enumerate(dict.fromkeys(u for _, _, s in some for u in s))}
                rows = features.of(list(place))
                x = [rows[[place[u] for u in s]].sum(axis=0).astype("<f4").tobytes() for _, _, s in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d for d, _, _ in some], pa.string()), pa.array([2 * y - 1 for _, y, _ in some], pa.float64()),
                     pa.array(x, pa.binary())], names=["doc_id", "label", "features"])

    sentences = stored(map_arrow(fit, featured, "doc_id string, label double, features binary"), "sentences")
    per_class = {r["label"]: r["n"] for r in sentences.groupBy("label").agg(F.count_distinct("doc_id").alias("n")).collect()}
    if len(per_class) < 2:
        return None
    share = {y: sum(per_class.values()) / (2 * n) for y, n in per_class.items()}

    weights = np.zeros(size + 1)
    for turn in range(rounds):
        now, first = weights.copy(), turn == 0

        def chosen(group: pd.DataFrame) -> pd.DataFrame:
            """The sentences that stand for a text: all at first, then the most toxic (of a clean text several)."""
            y = group["label"].iloc[0]
            if not first:
                x = np.frombuffer(b"".join(group["features"]), "<f4").reshape(len(group), -1)
                order = np.argsort(-(x @ now[:-1]), kind="stable")
                group = group.iloc[order[:1 if y > 0 else 8]]
            weight = share[y] / (len(group) if y < 0 or first else 1)
            return group.assign(weight=weight)[["features", "label", "weight"]]

        part = sentences.groupBy("doc_id").applyInPandas(chosen, "features binary, label double, weight double")
        weights = _newton(stored(part.coalesce(parts), "chosen"), size, ridge, weights)
    model = Model(marks, whiten, weights, np.zeros(2 * _TOP + 2))

    def summed(batches):
        for batch in batches:
            texts, y = batch.column("text").to_pylist(), batch.column("label")
            found = [x.tolist() for x in model.summaries(texts)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), y], names=["x", "label"])

    known = map_arrow(check, summed, "x array<double>, label double").toPandas()  # at most max_labelled short rows
    if known["label"].nunique() == 2:
        model.scale = _logistic(np.array(known["x"].tolist()), known["label"].to_numpy())
    else:
        model.scale = np.array([2.0, *[0.0] * (2 * _TOP + 1)])
    return model


def toxicity_of(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_labelled: int = 4000,
                landmarks: int = 192) -> DataFrame:
    """doc_id, held_out, score, predicted; learned from labelled rows whose id remainder is not 2 of 4."""
    docs = docs.select("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    fold = remainder("doc_id", 4)
    known = labels.select("doc_id", F.col("toxic").cast("double").alias("label")) \
        .filter("doc_id is not null and label is not null").filter(fold != 2)
    share = min(1.0, max_labelled / max(known.count(), 1))
    known = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1 << 30)) < int(share * (1 << 30)))
    # copies of a text count once: one label, one fold
    labelled = docs.join(known, "doc_id").groupBy(F.xxhash64("text").alias("copy"), "text") \
        .agg(F.min("doc_id").alias("doc_id"), F.max("label").alias("label")) \
        .select("doc_id", "text", "label", (F.pmod(F.col("copy"), F.lit(4)) == 0).alias("calibrate"))
    model = train(labelled, landmarks=landmarks)

    def score(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = np.zeros(len(texts)) if model is None else model.scores(texts)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "score"])

    scored = map_arrow(docs, score, f"doc_id {id_type}, score double")
    return scored.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
