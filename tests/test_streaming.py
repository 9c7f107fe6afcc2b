import json
import time

from pyspark.sql import functions as F

from strata.functions.money import amount_total
from strata.sources.ingest import IngestOptions, ingest, read_bronze, stream_bronze
from strata.streaming import live
from tests.conftest import write_lines

HINTS = "order_total DOUBLE, order_ts TIMESTAMP"


def order(oid, ts, channel="KIOSK", total=10.0):
    return json.dumps({"order_id": oid, "order_ts": ts, "channel": channel, "order_total": total})


def land_three(dirs):
    t = time.time() - 100  # increasing modification times fix the file (and micro-batch) order
    write_lines(dirs["landing"], "f1.json", [order("A", "2026-08-01T10:00:00"), order("B", "2026-08-01T11:00:00",
                                                                                       total=2.5)], mtime=t)
    write_lines(dirs["landing"], "f2.json", [order("C", "2099-01-01T12:00:00")], mtime=t + 10)
    write_lines(dirs["landing"], "f3.json", [order("D", "2026-08-02T09:00:00", "DELIVERY", 7.25)], mtime=t + 20)
    write_lines(dirs["landing"], "f4.json", [order("E", "2026-08-03T09:00:00")], mtime=t + 30)
    opts = IngestOptions(schema_hints=HINTS, max_files_per_trigger=1)
    ingest(spark_of(dirs), dirs["landing"], dirs["bronze"], dirs["state"], opts)
    return opts


_SPARK = {}


def spark_of(_):
    return _SPARK["s"]


def test_complete_mode_equals_batch(spark, dirs):
    _SPARK["s"] = spark
    opts = land_three(dirs)
    stream = stream_bronze(spark, dirs["bronze"], dirs["state"], opts, max_files_per_trigger=1)
    q = live.start(live.daily_window_agg(stream), name="live_complete", checkpoint=dirs["out"] + "/cp",
                   trigger={"availableNow": True})
    q.awaitTermination()
    got = {(str(r.order_date), r.channel): (r.orders, r.revenue) for r in spark.table("live_complete").collect()}
    b = read_bronze(spark, dirs["bronze"], dirs["state"], opts)
    exp = b.groupBy(F.to_date("order_ts").alias("d"), "channel").agg(
        F.count("*").alias("n"), amount_total("order_total").alias("r"))
    assert got == {(str(r.d), r.channel): (r.n, r.r) for r in exp.collect()}
    assert ("2099-01-01", "KIOSK") in got  # complete mode never drops late rows (D4)
    from strata.plans.verify import live_readout
    out = [(str(r.order_date), r.revenue) for r in live_readout(spark.table("live_complete")).collect()]
    assert out[0][0] == "2099-01-01" and [d for d, _ in out] == sorted((d for d, _ in out), reverse=True)
    assert len(q.recentProgress) == 4
    pf = live.progress_frame(spark, q)
    assert pf.count() == 4 and set(pf.columns) >= {"input_rows_per_second", "processed_rows_per_second",
                                                  "batch_duration_ms"}


def test_future_row_poisons_watermark_unless_filtered(spark, dirs):
    _SPARK["s"] = spark
    opts = land_three(dirs)
    results = {}
    for guard in (False, True):
        stream = stream_bronze(spark, dirs["bronze"], dirs["state"], opts, max_files_per_trigger=1)
        agg = live.daily_window_agg(stream, drop_future=guard, as_of="2026-08-31 00:00:00")
        name = f"live_update_{int(guard)}"
        q = live.start(agg, name=name, checkpoint=f"{dirs['out']}/cp{int(guard)}", output_mode="update",
                       trigger={"availableNow": True})
        q.awaitTermination()
        results[guard] = {str(r.order_date) for r in spark.table(name).collect()}
    # The 2099 row (batch 1) moves the watermark to 2098-12-31; late rows are filtered with the
    # previous batch's watermark, so batch 2 still lands and every row from batch 3 on is dropped.
    assert results[False] == {"2026-08-01", "2099-01-01", "2026-08-02"}
    assert results[True] == {"2026-08-01", "2026-08-02", "2026-08-03"}


def test_parquet_sink_continuous_trigger_and_stop_all(spark, dirs):
    _SPARK["s"] = spark
    opts = land_three(dirs)
    stream = stream_bronze(spark, dirs["bronze"], dirs["state"], opts)
    q = live.start(live.daily_window_agg(stream), name="live_parquet", checkpoint=dirs["out"] + "/cp",
                   sink="parquet", path=dirs["out"] + "/table", trigger={"processingTime": "1 second"})
    q.processAllAvailable()
    assert spark.read.parquet(dirs["out"] + "/table").agg(F.sum("orders")).first()[0] == 5
    assert "live_parquet" in live.stop_all(spark)
    assert not spark.streams.active


def test_reference_live_channel_sales_wiring(spark, dirs):
    _SPARK["s"] = spark
    land_three(dirs)
    q = live.live_channel_sales(spark, dirs["bronze"], dirs["state"], dirs["out"] + "/cp",
                                trigger={"availableNow": True})
    q.awaitTermination()
    rows = spark.sql("SELECT order_date, channel, orders, revenue FROM live_channel_sales "
                     "ORDER BY order_date DESC, revenue DESC").collect()
    assert sum(r.orders for r in rows) == 5 and len(q.recentProgress) == 4  # one file per micro-batch
