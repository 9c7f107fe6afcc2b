"""Verification queries over the pipeline's tables (V1–V8, U1, A8–A10, O-1..O-3).

Each function takes DataFrames (or a database name) and returns a
DataFrame; they mirror the reference's hand-run checks.  ORDER BY … LIMIT
queries are top-k reports (the limit is the feature) and carry key
tie-breakers so the output is deterministic.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.money import amount_average, amount_total


def per_file(bronze: DataFrame) -> DataFrame:
    """V1: rows and first ingestion time per source file."""
    return (bronze.groupBy("source_file")
            .agg(F.count(F.lit(1)).alias("rows"), F.min("ingested_at").alias("first_seen"))
            .orderBy("source_file"))


def total_rows(df: DataFrame) -> DataFrame:
    """V2: ``count(*) AS total_rows`` (the idempotency check)."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def column_population(bronze: DataFrame, columns=("loyalty_id", "promo_code"), by: str = "source_file") -> DataFrame:
    """V3: rows and non-null count of each (new) column per file."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count(F.col(c) if c in bronze.columns else F.lit(None)).alias(f"with_{c}") for c in columns]
    return bronze.groupBy(by).agg(*aggs).orderBy(by)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One ``(tbl, rows)`` row per table, as a UNION ALL of global counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("tbl"), "rows")
             for name, df in tables.items()]
    return reduce(DataFrame.unionAll, parts)


def store_league(daily_store_sales: DataFrame) -> DataFrame:
    """V5: orders, revenue and the *unweighted* mean of daily baskets per store, by revenue.

    The mean is ``round(avg(avg_basket_value), 2)`` summed exactly, rounded once.
    """
    return (daily_store_sales.groupBy("region", "city", "store_name")
            .agg(F.sum("orders").alias("orders"),
                 amount_total("revenue").alias("revenue"),
                 amount_average("avg_basket_value", F.count("avg_basket_value")).alias("avg_basket"))
            .select("region", "city", "store_name", "orders", "revenue", "avg_basket")
            .orderBy(F.col("revenue").desc(), "region", "city", "store_name"))


def top_items(top_items_view: DataFrame, k: int = 15) -> DataFrame:
    """V6 / O-3: the k best-selling items by revenue (ties broken by category, item)."""
    return (top_items_view.groupBy("category", "item_name")
            .agg(F.sum("units_sold").alias("units"), amount_total("revenue").alias("revenue"))
            .orderBy(F.col("revenue").desc(), "category", "item_name").limit(k))


def live_readout(live: DataFrame) -> DataFrame:
    """V7: the live channel table, newest day first, then by revenue."""
    return live.select("order_date", "channel", "orders", "revenue").orderBy(
        F.col("order_date").desc(), F.col("revenue").desc(), "channel")
