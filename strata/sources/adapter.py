"""Driver tables → order events and dimensions.

The pipeline's input is nested order events; the benchmark tables are a
TPC-H-like star.  This adapter derives events from them so every gold and
quality operator runs over whole tables and its work grows with them:

* one event per ``lineitem`` row (``items`` holds that line) plus one event
  with empty ``items`` for every order without lines.  An event's array is
  bounded by construction — nothing is collected per order, so a hot order
  key cannot build a giant row; ``explode`` still drops the empty ones;
* order fields come from ``orders``; the store is the customer's nation;
* stores = nation ⋈ region, menu = part.

Joins: ``orders ⋈ customer`` first (customer is a tenth of orders; broadcast
only when its estimated size allows), then ``⋈ lineitem`` on the order key as
a sort-merge join, so the large ``lineitem`` side is shuffled exactly once.
That fact-to-fact join is never broadcastable at the target scale; on small
inputs the planner would otherwise broadcast ``lineitem`` and run the whole
flatten-and-validate stage in the handful of tasks that scan ``orders``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.joins import broadcast_if_small
from strata.session import shuffles_dropped

ITEMS_TYPE = "array<struct<item_id:string,qty:bigint,unit_price:double>>"

# Fixed values of the adapter (the mapping of driver codes to the order
# domain, and the deterministic defect injection that exercises the rules).
CHANNEL_OF_PRIORITY = (
    ("1-URGENT", "DELIVERY"),
    ("2-HIGH", "DRIVE_THRU"),
    ("3-MEDIUM", "TAKEAWAY"),
    ("4-NOT SPECIFIED", "KIOSK"),
    ("5-LOW", "DINE_IN"),
)
PAYMENT_OF_STATUS = (("F", "CARD"), ("O", "UPI"), ("P", "CASH"))
# Defects, by key residue (every row is kept; the rules decide):
#   null store        o_orderkey % 97 = 0
#   unknown channel   o_orderkey % 89 = 0
#   year-2099 ts      o_orderkey % 101 = 0
#   negative total    o_orderkey % 103 = 0       (trips no rule, as in the reference)
#   zero qty          (l_orderkey + l_linenumber) % 83 = 0
#   negative price    (l_orderkey + l_linenumber) % 113 = 0
FUTURE_TS = "2099-01-01 12:00:00"


def _case(col: str, pairs) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs)
    return f"CASE {col} {arms} END"


# Column expressions shared verbatim by the Spark adapter and the DuckDB oracle
# (both engines accept this SQL subset).
ORDER_EXPRS = {
    "order_id": "CAST(o_orderkey AS STRING)",
    "store_id": "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(c_nationkey AS STRING) END",
    "order_ts": f"CASE WHEN o_orderkey % 101 = 0 THEN TIMESTAMP '{FUTURE_TS}' ELSE CAST(o_orderdate AS TIMESTAMP) END",
    "channel": f"CASE WHEN o_orderkey % 89 = 0 THEN 'UNKNOWN' ELSE {_case('o_orderpriority', CHANNEL_OF_PRIORITY)} END",
    "payment_method": _case("o_orderstatus", PAYMENT_OF_STATUS),
    "customer_id": "CAST(o_custkey AS STRING)",
    "order_total": "CASE WHEN o_orderkey % 103 = 0 THEN -o_totalprice ELSE o_totalprice END",
    "currency": "'INR'",
}
LINE_EXPRS = {
    "item_id": "CAST(l_partkey AS STRING)",
    "qty": "CASE WHEN (l_orderkey + l_linenumber) % 83 = 0 THEN 0 ELSE CAST(l_quantity AS BIGINT) END",
    "unit_price": "CASE WHEN (l_orderkey + l_linenumber) % 113 = 0 THEN -l_extendedprice ELSE l_extendedprice END",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _of_part(key: str, part: tuple[int, int]):
    return F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(part[1])) == part[0]


def order_events(spark: SparkSession, sf_dir: str, orders_where=None, part: tuple[int, int] | None = None) -> DataFrame:
    """Nested order events (the bronze shape) derived from orders, customer and lineitem.

    ``orders_where`` (a Column over ``orders``) restricts the orders *before*
    the joins, so a subset of events never pays for the full join.  ``part``
    ``(i, n)`` gives the i-th of n disjoint parts, by order key on both sides.
    """
    orders = _read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    if orders_where is not None:
        orders = orders.filter(orders_where)
    if part is not None:
        orders = orders.filter(_of_part("o_orderkey", part))
    cust = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    lines = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")
    if part is not None:
        lines = lines.filter(_of_part("l_orderkey", part))
    oc = orders.join(broadcast_if_small(cust), F.col("o_custkey") == F.col("c_custkey"), "left")
    order_cols = [F.expr(ORDER_EXPRS[k]).alias(k) for k in
                  ("order_id", "store_id", "order_ts", "channel", "payment_method", "customer_id")]
    tail = [F.expr(ORDER_EXPRS["order_total"]).alias("order_total"), F.expr(ORDER_EXPRS["currency"]).alias("currency")]
    item = F.struct(*[F.expr(e).alias(k) for k, e in LINE_EXPRS.items()])
    # Orders with lines: an inner join, whose hot keys AQE can split on either side.
    with_lines = (oc.hint("merge").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
                  .select(*order_cols, F.array(item).alias("items"), *tail))
    # Orders without lines: anti-join against the distinct line keys (map-side deduplicated,
    # so a hot key is one row per task).  ``explode`` drops these again; the optimizer prunes
    # this branch when nothing downstream keeps empty arrays.
    keys = lines.select(F.col("l_orderkey")).distinct()
    without = (oc.join(keys, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti")
               .select(*order_cols, F.array().cast(ITEMS_TYPE).alias("items"), *tail))
    return with_lines.unionByName(without)


# Landing files: gzip (about a twelfth of the text), which no reader can split, so of so many events at most; written by
# parts of the orders, so that the joins' shuffles on disk at once are those of one part (of so many lines at least).
LANDING_FILE_ROWS, LANDING_PART_ROWS, LANDING_PARTS = 100_000, 1_000_000, 4


def land_orders(spark: SparkSession, sf_dir: str, path: str, orders_where=None) -> None:
    """Writes ``order_events`` as NDJSON files below ``path``."""
    n = max(1, min(LANDING_PARTS, _read(spark, sf_dir, "lineitem").count() // LANDING_PART_ROWS))
    with shuffles_dropped(spark):
        for i in range(n):
            (order_events(spark, sf_dir, orders_where, (i, n) if n > 1 else None).write.mode("append")
             .option("compression", "gzip").option("maxRecordsPerFile", LANDING_FILE_ROWS).json(path))


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store dimension: one row per nation (the customer's nation is the order's store)."""
    nation = _read(spark, sf_dir, "nation")
    region = _read(spark, sf_dir, "region")
    return (nation.join(broadcast_if_small(region), F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .select(F.col("n_nationkey").cast("string").alias("store_id"), F.col("n_name").alias("store_name"),
                    F.col("n_name").alias("city"), F.col("r_name").alias("region")))


def menu_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Menu dimension: one row per part."""
    return _read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("item_id"), F.col("p_name").alias("item_name"),
        F.col("p_type").alias("category"), F.col("p_retailprice").alias("base_price"))


def oracle_lines_cte(line_join: str = "JOIN") -> str:
    """DuckDB text of the exploded adapter lines (before rules), for ``oracle_sql``.

    ``line_join="LEFT JOIN"`` keeps orders without lines (``explode_outer``).
    """
    sel = ",\n  ".join(f"{e} AS {k}" for k, e in {**ORDER_EXPRS, **LINE_EXPRS}.items()).replace("STRING", "VARCHAR")
    return f"""ev AS (
 SELECT {sel}
 FROM orders {line_join} lineitem ON l_orderkey = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey),
lines AS (
 SELECT order_id, store_id, customer_id, channel, payment_method, order_ts,
        CAST(order_ts AS DATE) AS order_date, item_id, CAST(qty AS INTEGER) AS qty, unit_price,
        qty * unit_price AS line_amount, CAST(order_total AS DOUBLE) AS order_total, currency
 FROM ev)"""


def order_date_expr():
    """``order_date`` of an event as an expression over ``orders`` columns (incl. the 2099 defect)."""
    return F.to_date(F.expr(ORDER_EXPRS["order_ts"]))
