"""Seeded synthetic order events as a Spark job.

Every value is a pure function of ``(seed, batch, row id, draw)`` through
``xxhash64``, so the output is identical however Spark partitions the work:
no driver loop, no Python RNG.  Items are built with ``transform(sequence(…))``
and the order total with ``aggregate``.  Defects are assigned round-robin to
the last ``n_defects`` rows of a batch; rows are then shuffled by a hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values that must equal the reference's fixtures: dimensions, value
# domains and the staged batch plan.
STORES = [
    ("ST001", "Koramangala Flagship", "Bengaluru", "South", "2019-03-14"),
    ("ST002", "Indiranagar 100ft Rd", "Bengaluru", "South", "2020-07-02"),
    ("ST003", "Bandra Linking Road", "Mumbai", "West", "2018-11-20"),
    ("ST004", "Powai Hiranandani", "Mumbai", "West", "2021-01-11"),
    ("ST005", "Connaught Place", "Delhi", "North", "2017-05-30"),
    ("ST006", "Cyber Hub Gurugram", "Delhi", "North", "2022-02-18"),
    ("ST007", "Park Street", "Kolkata", "East", "2020-09-09"),
    ("ST008", "Banjara Hills", "Hyderabad", "South", "2023-04-25"),
]
MENU = [
    ("IT100", "Chickenjoy 2pc", "Fried Chicken", 249.0),
    ("IT101", "Chickenjoy 6pc Bucket", "Fried Chicken", 649.0),
    ("IT102", "Spicy Chicken Burger", "Burgers", 179.0),
    ("IT103", "Classic Beef Burger", "Burgers", 199.0),
    ("IT104", "Jolly Spaghetti", "Pasta", 129.0),
    ("IT105", "Palabok Fiesta", "Pasta", 159.0),
    ("IT106", "Jolly Crispy Fries L", "Sides", 99.0),
    ("IT107", "Peach Mango Pie", "Desserts", 79.0),
    ("IT108", "Halo-Halo", "Desserts", 139.0),
    ("IT109", "Iced Latte", "Beverages", 129.0),
    ("IT110", "Cola 500ml", "Beverages", 69.0),
    ("IT111", "Veg Burger Deluxe", "Burgers", 169.0),
]
CHANNELS = ["DINE_IN", "TAKEAWAY", "DELIVERY", "DRIVE_THRU", "KIOSK"]
PAYMENTS = ["UPI", "CARD", "CASH", "WALLET", "NET_BANKING"]
PROMOS = ["FLAT50", "BOGO", "WEEKEND20", "APPONLY10"]
DEFECTS = ["null_store", "negative_total", "zero_qty", "unknown_channel", "future_ts"]
BATCHES = [
    # (file name, day, orders, new columns, defects)
    ("orders_2026_08_01.json", "2026-08-01", 100, False, 0),
    ("orders_2026_08_02.json", "2026-08-02", 120, False, 0),
    ("orders_2026_08_03.json", "2026-08-03", 150, True, 0),
    ("orders_2026_08_04.json", "2026-08-04", 140, True, 12),
    ("orders_2026_08_05.json", "2026-08-05", 130, True, 6),
]
FIRST_ORDER_NO = 1001


def _draw(seed: int, batch: int, k: int, *extra) -> Column:
    """Non-negative pseudo-random bigint for draw ``k`` of the current row."""
    return F.abs(F.xxhash64(F.lit(seed), F.lit(batch), F.col("id"), F.lit(k), *extra))


def _pick(values, h: Column) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.pmod(h, F.lit(len(values))) + 1).cast("int"))


def order_batch(spark: SparkSession, batch: int, day: str, n: int, new_cols: bool, n_defects: int,
                first_order_no: int, seed: int = 42) -> DataFrame:
    """One staged batch of nested order events (columns in event order)."""
    ids = spark.range(n)
    menu_ids = F.array(*[F.lit(m[0]) for m in MENU])
    menu_prices = F.array(*[F.lit(m[3]) for m in MENU])
    n_lines = (F.pmod(_draw(seed, batch, 1), F.lit(4)) + 1).cast("int")

    def item(i):
        h = F.abs(F.xxhash64(F.lit(seed), F.lit(batch), F.col("id"), F.lit(100), i))
        idx = (F.pmod(h, F.lit(len(MENU))) + 1).cast("int")
        qty = (F.pmod(F.abs(F.xxhash64(F.lit(seed), F.lit(batch), F.col("id"), F.lit(200), i)), F.lit(3)) + 1)
        return F.struct(F.element_at(menu_ids, idx).alias("item_id"), qty.cast("bigint").alias("qty"),
                        F.element_at(menu_prices, idx).alias("unit_price"))

    items = F.transform(F.sequence(F.lit(1), n_lines), item)
    total = F.round(F.aggregate(items, F.lit(0.0), lambda acc, x: acc + x["qty"] * x["unit_price"]), 2)
    secs = (F.pmod(_draw(seed, batch, 2), F.lit(15)) + 8) * 3600 + F.pmod(_draw(seed, batch, 3), F.lit(3600))
    ts = F.date_format(F.to_timestamp(F.lit(day)) + F.make_dt_interval(secs=secs.cast("int")),
                       "yyyy-MM-dd'T'HH:mm:ss")
    cust = F.format_string("CUST%04d", F.pmod(_draw(seed, batch, 4), F.lit(400)) + 1)
    defect_no = F.col("id") - F.lit(n - n_defects)
    kind = F.when(defect_no >= 0, F.element_at(F.array(*[F.lit(d) for d in DEFECTS]),
                                                (F.pmod(defect_no, F.lit(len(DEFECTS))) + 1).cast("int")))
    df = ids.select(
        "id", kind.alias("_defect"),
        F.concat(F.lit("ORD"), (F.col("id") + first_order_no).cast("string")).alias("order_id"),
        _pick([s[0] for s in STORES], _draw(seed, batch, 5)).alias("store_id"),
        ts.alias("order_ts"),
        _pick(CHANNELS, _draw(seed, batch, 6)).alias("channel"),
        _pick(PAYMENTS, _draw(seed, batch, 7)).alias("payment_method"),
        cust.alias("customer_id"), items.alias("items"), total.alias("order_total"), F.lit("INR").alias("currency"),
    )
    if new_cols:
        loyal = F.when(F.pmod(_draw(seed, batch, 8), F.lit(100)) < 60,
                       F.format_string("LOY%05d", F.pmod(_draw(seed, batch, 9), F.lit(250)) + 1))
        promo = F.when(F.pmod(_draw(seed, batch, 10), F.lit(100)) < 25, _pick(PROMOS, _draw(seed, batch, 11)))
        df = df.withColumn("loyalty_id", loyal).withColumn("promo_code", promo)
    d = F.col("_defect")
    df = (df.withColumn("store_id", F.when(d == "null_store", F.lit(None)).otherwise(F.col("store_id")))
          .withColumn("order_total", F.when(d == "negative_total", -F.abs("order_total")).otherwise(F.col("order_total")))
          .withColumn("items", F.when(d == "zero_qty", F.transform("items", lambda x, i: F.when(
              i == 0, x.withField("qty", F.lit(0).cast("bigint"))).otherwise(x))).otherwise(F.col("items")))
          .withColumn("channel", F.when(d == "unknown_channel", F.lit("UNKNOWN")).otherwise(F.col("channel")))
          .withColumn("order_ts", F.when(d == "future_ts", F.lit("2099-01-01T12:00:00")).otherwise(F.col("order_ts"))))
    return df.orderBy(F.xxhash64(F.lit(seed), F.lit(batch), F.col("id"))).drop("id", "_defect")


def staged_batches(spark: SparkSession, seed: int = 42) -> list[tuple[str, DataFrame]]:
    """The five staged batches of the reference's plan, with running order numbers."""
    out, start = [], FIRST_ORDER_NO
    for b, (name, day, n, new_cols, n_defects) in enumerate(BATCHES, start=1):
        out.append((name, order_batch(spark, b, day, n, new_cols, n_defects, start, seed)))
        start += n
    return out


def write_batch(df: DataFrame, landing_dir: str, name: str) -> str:
    """NDJSON, one file, under ``<landing>/<name>/`` (nulls written as ``null``, like the reference)."""
    path = f"{landing_dir.rstrip('/')}/{name}"
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def write_dimensions(spark: SparkSession, reference_dir: str) -> None:
    """``stores`` and ``menu_items`` as header CSVs."""
    s = spark.createDataFrame(STORES, "store_id string, store_name string, city string, region string, opened_date string")
    m = spark.createDataFrame(MENU, "item_id string, item_name string, category string, base_price double")
    s.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{reference_dir}/stores")
    m.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{reference_dir}/menu_items")
