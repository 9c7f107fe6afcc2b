"""The operators applied to the given tables with production parameters; SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (align, collocations, exact, frames, language, lines, neighbours, packing, quality, secrets, segment,
                        simhash, toxicity)
from strata.llm.common import table, vocabulary_path
from strata.session import new_run_dir


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"),
                                  capacity=1024, end_id=2)


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0, k=10)


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4, blocks=7)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_of(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op5_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = frames.write(table(spark, sf_dir, "documents"), f"{new_run_dir(spark, 'token-frames')}/ids",
                            vocabulary_path("word_bpe_49k.json"), end_id=1)
    return frames.read(spark, manifest, keep_ids=False)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_of(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return lines.line_dedup(docs, host_col="source", ratio=0.05, min_pages=10, report=True)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.train(secrets.labelled_sample(docs)))
    spans = F.col("secret_spans")
    base = F.filter(spans, lambda s: s["kind"] < 3)

    def number(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    return found.select("doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
                        F.sha2(secrets.spans_text(base), 256).alias("base_sha256"),
                        secrets.spans_text(spans).alias("spans"))


def op10_sampled_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.sampled(table(spark, sf_dir, "documents"), vocabulary_path("piece_bpe_32k.model"), k=2)


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=30, limit=2000)


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_of(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"),
                       vocabulary_path("piece_bpe_32k.model"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_best_fit_packing, op2_nearest_neighbours, op3_simhash_near_dedup, op4_quality_classifier, op5_token_frames,
        op6_language_id, op7_exact_dedup, op8_line_dedup, op9_secret_scan, op10_sampled_segmentation,
        op11_toxicity, op12_token_alignment, op13_phrase_collocations)}


def oracle_sql() -> dict[str, str]:
    return {
        "op7_exact_dedup": r"""
            SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
                   doc_id = min(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
            FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
            WINDOW same AS (PARTITION BY norm)""",
        "op8_line_dedup": r"""
            WITH page AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS parts FROM documents),
            site AS (SELECT source, count(*) AS pages FROM page WHERE source IS NOT NULL GROUP BY source),
            seen AS (SELECT source, unnest(list_distinct(parts)) AS line FROM page WHERE source IS NOT NULL),
            common AS (SELECT source, line, count(*) AS n FROM seen
                       WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY source, line),
            gone AS (SELECT source, list(line) AS dropped FROM common JOIN site USING (source)
                     WHERE n >= 10 AND n > 0.05 * pages GROUP BY source),
            kept AS (SELECT doc_id, page.source, text, parts,
                            list_filter(parts, lambda x: NOT list_contains(dropped, x)) AS rest, dropped
                     FROM page LEFT JOIN gone ON page.source = gone.source)
            SELECT doc_id, source, CASE WHEN dropped IS NULL OR text IS NULL THEN text
                        ELSE array_to_string(rest, chr(10)) END AS text,
                   CAST(coalesce(len(parts), 0) AS INTEGER) AS n_lines,
                   CAST(CASE WHEN dropped IS NULL OR text IS NULL THEN 0 ELSE len(parts) - len(rest) END AS INTEGER)
                     AS n_dropped
            FROM kept""",
        "op13_phrase_collocations": r"""
            WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS s
                           FROM documents),
            spoken AS (SELECT lang, list_filter(regexp_split_to_array(s, '[\x20\x09]+'), lambda x: x <> '') AS w
                       FROM piece),
            start AS (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i
                      FROM spoken, (VALUES (1), (2), (3), (4)) AS sizes(k)),
            counted AS MATERIALIZED (SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, count(*) AS n
                                     FROM start GROUP BY 1, 2, 3),
            total AS (SELECT lang, sum(n) AS n FROM counted WHERE k = 1 GROUP BY lang),
            candidate AS MATERIALIZED (SELECT * FROM counted WHERE k > 1 AND n >= 30),
            place AS (SELECT lang, phrase, k, n, unnest(range(1, k)) AS j FROM candidate),
            cut AS (SELECT *, array_to_string(list_slice(string_split(phrase, ' '), 1, j), ' ') AS p1,
                           array_to_string(list_slice(string_split(phrase, ' '), j + 1, k), ' ') AS p2 FROM place),
            scored AS (SELECT cut.lang, cut.phrase, cut.k, cut.n AS a, x.n AS l, y.n AS r,
                              (2000000 * cut.n::HUGEINT) // (x.n + y.n) AS score, cut.j
                       FROM cut JOIN counted x ON x.lang = cut.lang AND x.phrase = cut.p1
                                JOIN counted y ON y.lang = cut.lang AND y.phrase = cut.p2),
            lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
            kept AS (SELECT * FROM lowest c WHERE NOT EXISTS (
                       SELECT 1 FROM candidate d WHERE d.lang = c.lang AND d.k > c.k AND 100 * d.n >= 80 * c.a
                         AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' ')))
            SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
                   phrase, a, l, r, CAST(total.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
            FROM kept JOIN total ON total.lang = kept.lang
            QUALIFY rank <= 2000""",
    }
