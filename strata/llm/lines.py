"""Boilerplate lines by site-relative frequency.

A line's ratio at a site is the number of the site's pages that contain it over all pages of the site.  Lines above the
ratio (and on at least ``min_pages`` pages, so that a site of a few pages has no boilerplate by chance) are dropped
from that site's pages.  Lines are counted by a 128-bit digest, once per page, and pre-aggregated per task, so a line
that a third of all pages share is one row per task.  A site has at most (its mean number of distinct lines) /
ratio such lines; they travel to its pages as one array, by a broadcast where Spark's own size check allows it, else by a
shuffled join whose hot sites Spark splits.

With ``once``, a site's pages of equal text count as one page, in the lines' numbers and in the site's, so that copies
of a page are no evidence that its lines are boilerplate.  Pages are told apart by a digest; texts are not shuffled.

Defined results: lines end at U+000A and are compared exactly; blank lines always stay; a page with a NULL site keeps all
lines; NULL text stays NULL (and counts as a page); repeated rows are pages of their own; pages whose lines are
all dropped keep an empty text; an empty table gives no rows; other columns pass through.  ``once`` takes all NULL texts of a site for one
page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored

_HOST, _DROP, _LINES, _PAGE = "strata_line_host", "strata_line_drop", "strata_line_list", "strata_line_page"


def _digest(line):
    return F.unhex(F.md5(line))


def boilerplate(pages: DataFrame, host_col: str, text_col: str, ratio: float, min_pages: int,
                once: bool = False) -> DataFrame:
    """Per site with boilerplate: the site and the array of its lines' digests."""
    rows = pages.select(F.col(host_col).alias(_HOST), F.col(text_col).alias("text")).filter(F.col(_HOST).isNotNull())
    page = [_PAGE] if once else []
    rows = rows.withColumn(_PAGE, _digest(F.col("text"))).select(_HOST, *page, "text")
    each = rows.select(_HOST, *page)
    lines = (rows.select(_HOST, *page, F.explode(F.array_distinct(F.split("text", "\n"))).alias("line"))
             .filter(F.col("line").rlike(r"[^\x20\x09-\x0D]")).select(_HOST, *page, _digest(F.col("line")).alias("line")))
    if once:
        each, lines = each.distinct(), lines.distinct()
    totals = each.groupBy(_HOST).agg(F.count("*").alias("pages"))
    on = lines.groupBy(_HOST, "line").agg(F.count("*").alias("n")).filter(F.col("n") >= min_pages)
    return (on.join(totals, _HOST).filter(F.col("n") > F.lit(ratio) * F.col("pages"))
            .groupBy(_HOST).agg(F.collect_list("line").alias(_DROP)))


def line_dedup(pages: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = 0.05,
               min_pages: int = 10, report: bool = False, once: bool = False) -> DataFrame:
    """``pages`` without boilerplate lines; ``report`` appends (or replaces) ``n_lines`` and ``n_dropped``."""
    # stored: its true size then decides between a broadcast and a join whose hot sites can be split
    found = stored(boilerplate(pages, host_col, text_col, ratio, min_pages, once), "boilerplate")
    names = pages.columns
    split = F.split(F.col(text_col), "\n")
    kept = F.filter(F.col(_LINES), lambda line: ~F.array_contains(F.col(_DROP), _digest(line)))
    joined = (pages.withColumn(_HOST, F.col(host_col)).join(found, _HOST, "left")
              .withColumn(_LINES, F.when(F.col(_DROP).isNotNull(), split)))
    out = joined.withColumn(_LINES, kept)
    text = F.when(F.col(_LINES).isNull(), F.col(text_col)).otherwise(F.array_join(F.col(_LINES), "\n"))
    columns = [text.alias(c) if c == text_col else F.col(c) for c in names]
    if not report:
        return out.select(*columns)
    n_lines = F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(F.size(split))
    n_dropped = F.when(F.col(_LINES).isNull(), F.lit(0)).otherwise(n_lines - F.size(_LINES))
    columns = [c for c, n in zip(columns, names) if n not in ("n_lines", "n_dropped")]
    return out.select(*columns, n_lines.alias("n_lines"), n_dropped.alias("n_dropped"))
