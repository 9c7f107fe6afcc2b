"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

Each text gives a row of statistics (how much of it is letters, capitals, marks; how its words and lines repeat; and so
on).  Standardised, they pass through random Fourier features, cosines whose inner products approximate a Gaussian
kernel.  Every partition of the labelled rows sums its part of the normal equations, Spark adds the parts, and the driver
solves one system of a fixed size.  Ridge scores of rows kept out of that fit are binned; pool-adjacent-violators over
the bins gives the isotonic map from ridge score to probability.

Training uses at most about ``max_labelled`` labelled rows, chosen by id hash.  Defined results: NULL and empty texts
are scored like any text (their statistics are zero); rows with a NULL label or id are not learned from; without any
label every score is 0.5; repeated rows count as often as they occur; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_arrow, ship, stored
from strata.llm.language import remainder

STATISTICS = ("log_bytes", "letters", "capitals", "digits", "spaces", "beyond_ascii", "full_stops", "commas", "marks",
              "symbols", "entropy", "log_words", "word_length", "word_length_spread", "distinct_words", "top_word",
              "same_as_last", "distinct_pairs", "capital_words", "odd_ends", "log_lines", "repeated_lines", "line_length",
              "lone_marks")
_CLASSES = {"letters": b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "capitals":
            b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": b"0123456789", "spaces": b" \t\n\r\x0b\x0c",
            "beyond_ascii": bytes(range(128, 256)), "full_stops": b".", "commas": b",", "marks": b"!?;:'\"()-",
            "symbols": b"#$%&*+/<=>@[\\]^_`{|}~"}


def _class_table() -> np.ndarray:
    table = np.zeros((256, len(_CLASSES)))
    for j, members in enumerate(_CLASSES.values()):
        table[list(members), j] = 1
    return table


_TABLE = _class_table()


def statistics(raw: bytes | None) -> list[float]:
    """The ``STATISTICS`` of a UTF-8 text; all finite."""
    raw = raw or b""
    n = len(raw)
    if not n:
        return [0.0] * len(STATISTICS)
    by_byte = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    share = by_byte[by_byte > 0] / n
    out = [np.log1p(n), *(by_byte @ _TABLE / n), float(-(share * np.log2(share)).sum())]
    words = raw.split()
    k = len(words)
    if not k:
        return [float(x) for x in out] + [0.0] * (len(STATISTICS) - len(out))
    length = np.fromiter(map(len, words), dtype=np.int64, count=k)
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    same = sum(map(bytes.__eq__, words, words[1:]))
    # of the word forms, each as often as it occurs
    capitals = odd = lone = 0
    for word, times in counts.items():
        capitals += times * word.isupper()
        odd += times * (word[-1] < 128 and not chr(word[-1]).isalnum() and word[-1:] not in b".,;:")
        lone += times * (len(word) == 1 and not word.isalnum())
    lines = raw.split(b"\n")
    out += [np.log1p(k), length.mean(), length.std(), len(counts) / k, max(counts.values()) / k, same / k,
            pairs / k, capitals / k, odd / k, np.log1p(len(lines)), 1 - len(set(lines)) / len(lines),
            np.log1p(n / len(lines)), lone / k]
    return [float(x) for x in out]


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray  # of the random Fourier features
    offset: np.ndarray
    ridge: np.ndarray
    at: np.ndarray  # isotonic map: ridge scores and probabilities between which it is linear
    probability: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.spread, -8, 8)
        waves = np.sqrt(2 / len(self.offset)) * np.cos(z @ self.weights + self.offset)
        return np.hstack([waves, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.ridge

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.at, self.probability)


def with_statistics(docs: DataFrame, text_col: str = "text", out_col: str = "stats") -> DataFrame:
    ship(docs.sparkSession)

    @F.pandas_udf("array<double>")
    def of(raw: pd.Series) -> pd.Series:
        return pd.Series([statistics(x) for x in raw])

    return docs.withColumn(out_col, of(F.col(text_col).cast("binary")))


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


def _normal_equations(rows: DataFrame, model: Model, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """X'X and X'y, summed per partition (a bounded number of them) and then over partitions, row by row."""
    size = len(model.offset) + 1

    def sums(batches):
        gram = np.zeros((size, size + 1))
        for batch in batches:
            if batch.num_rows:
                x = model.features(_matrix(batch.column("stats")))
                y = batch.column("label").to_numpy(zero_copy_only=False)
                gram += x.T @ np.hstack([x, y[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array([r.tobytes() for r in gram], pa.binary())],
                                         names=["i", "row"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(r) for r in group["row"]], axis=0)
        return pd.DataFrame({"i": group["i"].iloc[:1], "row": [total.tobytes()]})

    partial = map_arrow(rows.repartition(parts), sums, "i long, row binary")
    total = np.zeros((size, size + 1))
    for r in partial.groupBy("i").applyInPandas(add, "i long, row binary").collect():  # size rows of size numbers
        total[r["i"]] = np.frombuffer(r["row"])
    return total[:, :-1], total[:, -1]


def isotonic(weight: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the best non-decreasing share of ones for bins in order (weights above 0)."""
    blocks: list[list[float]] = []
    for w, s in zip(weight.tolist(), ones.tolist()):
        blocks.append([w, s, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            w2, s2, n2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + w2, blocks[-1][1] + s2, blocks[-1][2] + n2]
    return np.concatenate([np.full(n, s / w) for w, s, n in blocks])


def train(labelled: DataFrame, waves: int = 320, ridge: float = 1e-3, bins: int = 1000, parts: int = 24,
          seed: int = 7) -> Model | None:
    """From rows (``stats``, ``label`` 0 or 1, ``calibrate``): ridge on the rows that aren't, the map on those that are."""
    k = len(STATISTICS)
    fit, check = labelled.filter(~F.col("calibrate")), labelled.filter("calibrate")
    moments = fit.agg(F.count("*").alias("n"), *[F.avg(F.get("stats", F.lit(i))).alias(f"m{i}") for i in range(k)],
                      *[F.stddev_pop(F.get("stats", F.lit(i))).alias(f"s{i}") for i in range(k)]).first()
    if not moments["n"]:
        return None
    rng = np.random.default_rng(seed)
    mean = np.array([moments[f"m{i}"] for i in range(k)])
    spread = np.array([moments[f"s{i}"] for i in range(k)])
    model = Model(mean, np.where(spread > 1e-9, spread, 1.0), rng.normal(size=(k, waves)) / np.sqrt(k),
                  rng.uniform(0, 2 * np.pi, waves), np.zeros(waves + 1), np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    gram, moment = _normal_equations(fit, model, parts)
    model.ridge = np.linalg.solve(gram + ridge * moments["n"] / waves * np.eye(len(gram)), moment)

    def raw(batches):
        for batch in batches:
            if batch.num_rows:
                place = np.clip((model.raw(_matrix(batch.column("stats"))) + 0.5) / 2, 0, 1)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum((place * bins).astype(np.int64), bins - 1)),
                                                  batch.column("label").cast(pa.float64())], names=["bin", "label"])

    counted = sorted(map_arrow(check, raw, "bin long, label double").groupBy("bin")
                     .agg(F.count("*").alias("n"), F.sum("label").alias("ones")).collect())
    if counted:
        weight, ones = np.array([r["n"] for r in counted], float), np.array([r["ones"] for r in counted])
        model.at = (np.array([r["bin"] for r in counted]) + 0.5) / bins * 2 - 0.5
        model.probability = np.clip(isotonic(weight, ones), 0, 1)
    return model


def quality_of(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_labelled: int = 200_000) -> DataFrame:
    """doc_id, held_out, score, predicted; learned from labelled rows whose id remainder is not 0 of 5 (4: the map)."""
    rows = stored(with_statistics(docs.select("doc_id", "text")).select("doc_id", "stats"), "statistics")
    fold = remainder("doc_id", 5)
    known = labels.select("doc_id", F.col("quality").cast("double").alias("label")) \
        .filter("doc_id is not null and label is not null").filter(fold != 0)
    share = min(1.0, max_labelled / max(known.count(), 1))
    known = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 30)) < int(share * (1 << 30)))
    labelled = stored(rows.join(known, "doc_id").select("stats", "label", (fold == 4).alias("calibrate")), "labelled")
    model = train(labelled)
    fields = [f for f in rows.schema.fields if f.name == "doc_id"]

    def score(batches):
        for batch in batches:
            n = batch.num_rows
            if n:
                s = np.full(n, 0.5) if model is None else model.score(_matrix(batch.column("stats")))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s)], names=["doc_id", "score"])

    scored = map_arrow(rows, score, f"doc_id {fields[0].dataType.simpleString()}, score double")
    return scored.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
