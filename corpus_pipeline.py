"""Documents to packed training sequences: each stage is one operator of ``strata.llm`` over all that the last one kept.

Language identification drops the documents it rejects; line dedup takes boilerplate lines out of texts; SimHash near-dedup
keeps one document of each group; the secret scan masks what it finds; packing places the token ids of the rest in
sequences.  Stages that change a text set ``n_chars`` to its new length.  Columns that ``documents`` has besides pass
through to the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import language, lines, packing, secrets, simhash
from strata.llm.common import stored, table, vocabulary_path

_SPANS, _OLD = "strata_secret_spans", "strata_old_text"


def _recounted(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``; ``n_chars`` follows a changed text (old text in ``_OLD``)."""
    if "n_chars" in docs.columns:
        same = F.col("text").eqNullSafe(F.col(_OLD))
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.when(same, F.col("n_chars"))
                                     .otherwise(F.length("text").cast(kind)))
    return changed.select(*docs.columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those far from every centroid of the learned languages."""
    return language.keep_identified(docs)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that more than a twentieth of a source's different texts contain; every document stays.

    Copies count once: near-dedup, which comes next, keeps one of them, and its text must be whole.  Three different texts
    prove that a line is repeated, so that the ratio decides at small sources too.
    """
    out = lines.line_dedup(docs.withColumn(_OLD, F.col("text")), host_col="source", ratio=0.05, min_pages=3, once=True)
    return _recounted(out, docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each near-duplicate group."""
    return simhash.drop_near_duplicates(docs, shingle=4, max_bits=4, blocks=7)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes [SECRET] over what the scan finds; every document stays."""
    found = secrets.scan(docs, secrets.train(secrets.labelled_sample(docs)), out_col=_SPANS)
    masked = found.withColumn(_OLD, F.col("text")).withColumn("text", secrets.redacted(F.col("text"), F.col(_SPANS)))
    return _recounted(masked, docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their ids and their place in sequences of 1024 tokens."""
    return packing.pack_documents(docs, vocabulary_path("byte_bpe_50k.json"), capacity=1024, end_id=2, keep_ids=True)


STAGES = [("language_id", identify_language), ("line_dedup", drop_boilerplate),
          ("simhash_near_dedup", drop_near_duplicates), ("secret_scan", mask_secrets),
          ("best_fit_packing", pack_sequences)]
ORACLE_SQL = None  # models and hashed fingerprints: tests compare the stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
