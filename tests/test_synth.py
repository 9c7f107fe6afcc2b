import json

from pyspark.sql import functions as F

from tests import synth


def test_staged_batches_shape_and_defects(spark):
    batches = synth.staged_batches(spark)
    assert [n for n, _ in batches] == [b[0] for b in synth.BATCHES]
    counts = [df.count() for _, df in batches]
    assert counts == [100, 120, 150, 140, 130]
    for (name, df), (_, _, _, new_cols, _) in zip(batches, synth.BATCHES):
        assert ("loyalty_id" in df.columns) == new_cols and ("promo_code" in df.columns) == new_cols
    b4 = batches[3][1]
    assert b4.filter(F.col("store_id").isNull()).count() == 3
    assert b4.filter(F.col("order_total") < 0).count() == 3
    assert b4.filter(F.col("items")[0]["qty"] == 0).count() == 2
    assert b4.filter(F.col("channel") == "UNKNOWN").count() == 2
    assert b4.filter(F.col("order_ts").startswith("2099")).count() == 2
    b5 = batches[4][1]
    assert [b5.filter(c).count() for c in (F.col("store_id").isNull(), F.col("order_total") < 0,
                                           F.col("items")[0]["qty"] == 0, F.col("channel") == "UNKNOWN",
                                           F.col("order_ts").startswith("2099"))] == [2, 1, 1, 1, 1]
    ids = [r.order_id for df in (b for _, b in batches) for r in df.select("order_id").collect()]
    assert len(set(ids)) == 640 and min(int(i[3:]) for i in ids) == 1001


def test_value_domains(spark):
    df = synth.staged_batches(spark)[0][1]
    r = df.select(
        F.min(F.size("items")), F.max(F.size("items")),
        F.min(F.expr("array_min(transform(items, x -> x.qty))")), F.max(F.expr("array_max(transform(items, x -> x.qty))")),
        F.min(F.hour(F.to_timestamp("order_ts"))), F.max(F.hour(F.to_timestamp("order_ts"))),
        F.max(F.abs(F.col("order_total") - F.round(F.expr(
            "aggregate(items, 0D, (a, x) -> a + x.qty * x.unit_price)"), 2))),
    ).first()
    assert (r[0], r[1]) == (1, 4) and (r[2], r[3]) == (1, 3) and 8 <= r[4] <= r[5] <= 22 and r[6] == 0
    assert {x.currency for x in df.select("currency").distinct().collect()} == {"INR"}
    assert {x.channel for x in df.select("channel").distinct().collect()} <= set(synth.CHANNELS)


def test_same_content_however_partitioned(spark):
    df = synth.order_batch(spark, 3, "2026-08-03", 150, True, 0, 1221)
    a = sorted(json.dumps(r.asDict(recursive=True), sort_keys=True) for r in df.collect())
    b = sorted(json.dumps(r.asDict(recursive=True), sort_keys=True) for r in df.repartition(7).collect())
    assert a == b
    again = synth.order_batch(spark, 3, "2026-08-03", 150, True, 0, 1221)
    assert a == sorted(json.dumps(r.asDict(recursive=True), sort_keys=True) for r in again.collect())
