import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from strata.operators import gold
from strata.operators.joins import broadcast_if_small, estimated_bytes, left_join_dim
from strata.plans.dimension import Dimension
from strata.plans.refresh import read_view, refresh_view
from strata.sources.ingest import IngestOptions, ingest
from tests.conftest import write_lines


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_only_behind_the_size_check(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only our hint may broadcast
    try:
        facts = spark.range(1000).select((F.col("id") % 10).cast("string").alias("k"), "id")
        spark.createDataFrame([(str(i), f"n{i}") for i in range(10)], "k string, name string") \
            .write.parquet(str(tmp_path / "dim"))
        dim = spark.read.parquet(str(tmp_path / "dim"))
        assert 0 < estimated_bytes(dim) < 1_000_000
        unknown = spark.createDataFrame([("1", "a")], "k string, name string")
        assert broadcast_if_small(unknown) is unknown  # no estimate -> no broadcast
        assert "BroadcastHashJoin" in plan_of(left_join_dim(facts, dim, "k"))
        assert "BroadcastHashJoin" not in plan_of(left_join_dim(facts, dim, "k", max_bytes=0))
        assert broadcast_if_small(dim, max_bytes=0) is dim
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def silver_rows(batch, day, orders):
    return [(f"O{batch}-{i}", "S1", "C1", "KIOSK", "UPI", None, day, f"I{i % 3}", 1 + i % 2, 10.0,
             10.0 * (1 + i % 2), 10.0, "INR", batch) for i in range(orders)]


SCHEMA = ("order_id string, store_id string, customer_id string, channel string, payment_method string, "
          "order_ts timestamp, order_date date, item_id string, qty int, unit_price double, line_amount double, "
          "order_total double, currency string, batch_id bigint")


def test_incremental_refresh_equals_full(spark, tmp_path):
    import datetime as dt
    d = lambda s: dt.date.fromisoformat(s)
    rows = silver_rows(0, d("2026-07-30"), 5) + silver_rows(0, d("2026-08-01"), 4)
    path = str(tmp_path / "silver")
    spark.createDataFrame(rows, SCHEMA).write.partitionBy("batch_id").parquet(path)
    target, state = str(tmp_path / "view"), str(tmp_path / "state")
    info = refresh_view(spark, "mix", gold.channel_mix, spark.read.parquet(path), target, state)
    assert info["mode"] == "full"
    more = silver_rows(1, d("2026-08-01"), 3) + silver_rows(1, None, 2) + silver_rows(1, d("2026-08-02"), 1)
    spark.createDataFrame(more, SCHEMA).write.mode("append").partitionBy("batch_id").parquet(path)
    silver = spark.read.parquet(path)
    info = refresh_view(spark, "mix", gold.channel_mix, silver, target, state)
    assert info["mode"] == "incremental" and info["affected_keys"] == 3  # 2026-08-01, NULL, 2026-08-02
    got = read_view(spark, target, gold.CHANNEL_MIX)
    full = gold.channel_mix(silver.drop("batch_id"))
    assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0
    assert got.filter(F.col("order_date").isNull()).first().orders == 2
    assert refresh_view(spark, "mix", gold.channel_mix, silver, target, state)["mode"] == "noop"


STORE_SCHEMA = "store_id string, store_name string, city string, region string"
STORES = [("S1", "One", "Pune", "West"), ("S2", "Two", "Delhi", "North"), ("S3", "Three", None, None),
          (None, "Nowhere", None, None)]


def _dimension_case(spark, tmp_path):
    """Three months of silver, one store each in two of them and three stores (one of them NULL) in the last."""
    import datetime as dt
    d = dt.date.fromisoformat

    def lines(batch, day, store, orders):
        return [(r[0] + f"{store}", store, *r[2:]) for r in silver_rows(batch, d(day), orders)]

    path = str(tmp_path / "silver")

    def land(rows):
        spark.createDataFrame(rows, SCHEMA).write.mode("append").partitionBy("batch_id").parquet(path)
        return spark.read.parquet(path)

    def refresh(silver, stores, **kw):
        dim = spark.createDataFrame(stores, STORE_SCHEMA)
        info = refresh_view(spark, "sales", lambda x: gold.daily_store_sales(x, dim), silver,
                            str(tmp_path / "view"), str(tmp_path / "state"),
                            dimension=Dimension(dim, "store_id", ("store_name", "city", "region")), **kw)
        got = read_view(spark, str(tmp_path / "view"), gold.DAILY_STORE_SALES)
        full = gold.daily_store_sales(silver.drop("batch_id"), dim)
        assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0
        return info

    silver = land(lines(0, "2026-06-10", "S1", 3) + lines(0, "2026-07-10", "S2", 4)
                  + lines(0, "2026-08-10", "S1", 2) + lines(0, "2026-08-11", "S3", 2) + lines(0, "2026-08-11", None, 2))
    return land, lines, refresh, silver


def _month_files(tmp_path):
    return {m.name: sorted(f.name for f in m.glob("*.parquet")) for m in (tmp_path / "view").glob("order_date_month=*")}


def test_view_follows_a_changed_dimension(spark, tmp_path):
    land, lines, refresh, silver = _dimension_case(spark, tmp_path)
    assert refresh(silver, STORES)["mode"] == "full"
    assert refresh(silver, list(reversed(STORES)))["mode"] == "noop"  # the same rows in another order
    before = _month_files(tmp_path)
    renamed = [("S2", "Second", "Delhi", "North") if s[0] == "S2" else s for s in STORES]
    assert refresh(silver, renamed) == {"mode": "dimension", "affected_keys": 1, "through": 0}
    after = _month_files(tmp_path)
    assert [m for m in before if before[m] != after[m]] == ["order_date_month=2026-07-01"]  # only its months
    # S1 goes, S3 gets a city, S9 is new and sells nothing yet; a new batch lands as well
    third = [s for s in renamed if s[0] not in ("S1", "S3")] + [("S3", "Three", "Goa", None), ("S9", "Nine", "x", "y")]
    more = land(lines(1, "2026-07-10", "S9", 1) + lines(1, "2026-09-01", "S1", 1))
    before = _month_files(tmp_path)
    assert refresh(more, third)["mode"] == "incremental"
    assert before["order_date_month=2026-06-01"] != _month_files(tmp_path)["order_date_month=2026-06-01"]
    assert refresh(more, third)["mode"] == "noop"


def test_changes_of_a_dimension_are_found_again(spark, tmp_path):
    """Digests that are missing (an older view, a run that died) or that no write has followed."""
    import shutil
    _, _, refresh, silver = _dimension_case(spark, tmp_path)
    refresh(silver, STORES)
    shutil.rmtree(tmp_path / "state" / "_refresh" / "sales_dimension")
    renamed = [("S1", "First", "Pune", "West")] + STORES[1:]
    assert refresh(silver, renamed)["mode"] == "dimension"
    # several rows for a key: the least one labels the view, so a greater one changes nothing
    assert refresh(silver, renamed + [("S1", "Zzz", "Pune", "West")])["mode"] == "noop"
    assert refresh(silver, renamed + [("S1", "Aaa", "Pune", "West")])["affected_keys"] == 1
    assert refresh(silver, [])["affected_keys"] == 3  # an emptied dimension
