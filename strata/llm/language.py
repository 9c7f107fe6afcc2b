"""Language identification by nearest centroid.

A text is the unit vector of its hashed character 2- and 3-grams (bytes of the lower-cased text, everything but letters as
one space), weighted (1 + log count) x inverse document frequency.  Each language has several centroids, the means of
clusters of its training vectors; a text takes the language of the centroid of greatest cosine.  It is rejected where it
has no letter, or where the cosine is below what nearly all training vectors of that centroid reach (of its language,
where the centroid has fewer than 100).

Document frequencies cover every training row: each partition sums its own, Spark adds them up by n-gram bucket.
Clusters are fitted on at most ``per_language`` rows of each language, chosen by id hash, one language per task.

Defined results: NULL text, text without a letter and any text where nothing was learned are ``und`` with score 0 and
rejected; rows with a NULL id or NULL language are predicted but not learned from; repeated rows count as often as they
occur; an empty table gives no rows; other columns pass through, ones named like an output are replaced.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import map_arrow, ship, stored

BUCKETS = 1 << 12
UNKNOWN = "und"
_NOT_LETTERS = bytes(range(128)).translate(None, string.ascii_letters.encode())
_SPACED = bytes.maketrans(_NOT_LETTERS, b" " * len(_NOT_LETTERS))


@dataclass
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray  # unit rows
    least: np.ndarray  # cosine below which a text is rejected
    idf: np.ndarray


def ngram_counts(text: str | None) -> np.ndarray:
    """Counts of hashed 2- and 3-grams, by bucket."""
    raw = f" {text or ''} ".lower().encode().translate(_SPACED)
    counts = np.zeros(BUCKETS, dtype=np.int64)
    step = 1 << 20  # a very long text is counted in parts that overlap by one 3-gram
    for at in range(0, len(raw), step):
        b = np.frombuffer(raw[at:at + step + 2], dtype=np.uint8).astype(np.uint32)
        if len(b) < 2:
            break
        two = (b[:-1] << np.uint32(8)) | b[1:]
        three = (two[:-1] << np.uint32(8)) | b[2:]
        for codes, salt in ((two[:step], 0x9E3779B1), (three[:step], 0x85EBCA6B)):
            hashed = (codes + np.uint32(1)) * np.uint32(salt)
            counts += np.bincount(hashed >> np.uint32(20), minlength=BUCKETS)
    return counts


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0).astype(np.float32) * idf
    norm = np.linalg.norm(v, axis=-1, keepdims=True)
    return v / np.where(norm > 0, norm, 1)


# ------------------------------------------------------------------ training
def _document_frequency(texts: DataFrame) -> tuple[int, np.ndarray]:
    def count(batches):
        n, df = 0, np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                df += ngram_counts(text.as_py()) > 0
                n += 1
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, BUCKETS)), pa.array(np.concatenate([[n], df]))],
                                             names=["bucket", "n"])

    total = np.zeros(BUCKETS + 1, dtype=np.int64)
    for row in map_arrow(texts, count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row["bucket"] + 1] = row["n"]
    return int(total[0]), total[1:]


def _clusters(vectors: np.ndarray, k: int, rounds: int = 12, share: float = 0.02) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from drawn starts: centroids and the nearest one of each vector.

    Starts are drawn by their distance from those at hand (k-means++, fixed seed).  After half the rounds, clusters below
    ``share`` of the vectors are merged into the others: they are outliers, not a part of the language.
    """
    rng = np.random.default_rng(0)
    starts = [int(rng.integers(len(vectors)))]
    while len(starts) < min(k, len(vectors)):
        away = np.maximum(1 - (vectors @ vectors[starts].T).max(axis=1), 0).astype(np.float64)
        if away.sum() < 1e-6:
            break
        starts.append(int(rng.choice(len(vectors), p=away / away.sum())))
    centroids = vectors[starts]
    for i in range(rounds):
        if i == rounds // 2:
            sizes = np.bincount((vectors @ centroids.T).argmax(axis=1), minlength=len(centroids))
            centroids = centroids[sizes >= min(share * len(vectors), sizes.max())]
        nearest = (vectors @ centroids.T).argmax(axis=1)
        sums = np.stack([vectors[nearest == i].sum(axis=0) if (nearest == i).any() else centroids[i]
                         for i in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centroids, (vectors @ centroids.T).argmax(axis=1)


def train(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = 1000, clusters: int = 4, margin: float = 0.25) -> Model:
    """Learns from every row given; ``per_language`` bounds the rows of a language that clusters are fitted on."""
    ship(rows.sparkSession)
    known = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")) \
        .filter("lang is not null and text is not null")
    total, df = _document_frequency(known.select("text"))
    idf = np.log((1 + total) / (1 + df)).astype(np.float32) + 1
    sizes = stored(known.groupBy("lang").count(), "languages")  # stored: a row per language, broadcast for its true size
    pick = F.pmod(F.xxhash64("id", F.lit("language")), F.lit(1 << 30))
    share = F.least(F.lit(1.0), F.lit(1.3 * per_language) / F.col("count")) * (1 << 30)
    drawn = known.withColumn("pick", pick).join(sizes, "lang").filter(F.col("pick") < share)
    order = Window.partitionBy("lang").orderBy("pick")
    drawn = drawn.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= per_language).select("lang", "text")

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        # sorted: the drawn starts do not depend on the order of arrival
        vectors = np.stack([_weighted(ngram_counts(t), idf) for t in sorted(group["text"])])
        centroids, nearest = _clusters(vectors, clusters)
        cosine = (vectors * centroids[nearest]).sum(axis=1)
        own = [cosine[nearest == i] for i in range(len(centroids))]
        own = [c if len(c) >= 100 else cosine for c in own]  # too few for a quantile: all of the language's
        return pd.DataFrame([{
            "lang": group["lang"].iloc[0], "centroid": c.astype("<f4").tobytes(),
            "least": margin * float(np.quantile(own[i], 0.01))}
            for i, c in enumerate(centroids)])

    # languages x clusters rows of 16 KB
    found = sorted(drawn.groupBy("lang").applyInPandas(fit, "lang string, centroid binary, least double").collect())
    return Model([r["lang"] for r in found],
                 np.stack([np.frombuffer(r["centroid"], "<f4") for r in found]) if found else np.zeros((0, BUCKETS)),
                 np.array([r["least"] for r in found]), idf)


# ------------------------------------------------------------------ prediction
def identify(docs: DataFrame, model: Model, text_col: str = "text", prefix: str = "lang_") -> DataFrame:
    """``docs`` with ``<prefix>pred``, ``<prefix>score`` (cosine, 0 to 1) and ``<prefix>rejected``."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x clusters x 16 KB

    @F.pandas_udf("pred string, score double, rejected boolean")
    def nearest(texts: pd.Series) -> pd.DataFrame:
        import regex

        m, letter = shared.value, regex.compile(r"\p{L}").search
        out = [(UNKNOWN, 0.0, True)] * len(texts)
        has = [i for i, t in enumerate(texts) if t and letter(t)] if m.languages else []
        for at in range(0, len(has), 512):
            part = has[at:at + 512]
            cosine = _weighted(np.stack([ngram_counts(texts.iloc[i]) for i in part]), m.idf) @ m.centroids.T
            best = cosine.argmax(axis=1)
            for i, j, c in zip(part, best, cosine[np.arange(len(part)), best]):
                out[i] = (m.languages[j], min(max(float(c), 0.0), 1.0), bool(c < m.least[j]))
        return pd.DataFrame(out, columns=["pred", "score", "rejected"])

    found = docs.withColumn(f"{prefix}found", nearest(F.col(text_col)))
    names = [f"{prefix}{n}" for n in ("pred", "score", "rejected")]
    return found.select(*[c for c in docs.columns if c not in names],
                        *[F.col(f"{prefix}found.{n}").alias(f"{prefix}{n}") for n in ("pred", "score", "rejected")])


def remainder(id_col: str, modulus: int):
    """crc32 of the id as text, modulo; NULL for a NULL id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(modulus))


def language_of(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected; learned from the documents whose id remainder is not 1 of 3."""
    model = train(docs.filter(remainder("doc_id", 3) != 1))
    own = docs.select("doc_id", "text").withColumn("held_out", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)))
    return identify(own, model).select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"),
                                       F.col("lang_rejected").alias("rejected"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that identification rejects."""
    model = train(docs.filter(remainder("doc_id", 3) != 1))
    return identify(docs, model, prefix="strata_lang_").filter(~F.col("strata_lang_rejected")).select(*docs.columns)
