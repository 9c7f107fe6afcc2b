"""Input that is not well behaved, and replays: nothing is changed, dropped or counted twice."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F
from strata.operators import gold
from strata.plans.event_log import EventLog
from strata.plans.flows import run_silver
from strata.plans.pipeline import order_pipeline
from strata.sources import storage
from strata.sources.ingest import IngestOptions, bronze_schema, ingest, read_bronze, stream_bronze
from strata.sources.schema_store import SchemaStore
from strata.streaming import live
from tests.conftest import write_lines


def _land(spark, dirs, name, rows, opts=None, retries=1):
    write_lines(dirs["landing"], name, [json.dumps(r) if not isinstance(r, str) else r for r in rows])
    ingest(spark, dirs["landing"], dirs["bronze"], dirs["state"], opts or IngestOptions(), retries=retries)
    return read_bronze(spark, dirs["bronze"], dirs["state"], opts)


def _rows(df, *cols):
    return [tuple(r) for r in df.select(*cols, "_rescued_data").orderBy("id").collect()]


def test_values_that_do_not_fit_are_rescued_not_changed(spark, dirs):
    opts = IngestOptions(schema="id BIGINT, qty BIGINT, ok BOOLEAN, x DOUBLE", evolution_mode="rescue")
    rows = [{"id": 1, "qty": 2, "ok": True, "x": 1}, {"id": 2, "qty": 2.75}, {"id": 3, "ok": 7}, {"id": 4, "qty": True},
            {"id": 5, "qty": 2.0, "x": 249.5}, {"id": 6, "x": 9007199254740993}, {"id": 7, "qty": "12"}]
    out = _rows(_land(spark, dirs, "a.json", rows, opts), "id", "qty", "ok", "x")
    assert out == [(1, 2, True, 1.0, None), (2, None, None, None, '{"qty":2.75}'), (3, None, None, None, '{"ok":7}'),
                   (4, None, None, None, '{"qty":true}'), (5, 2, None, 249.5, None),
                   (6, None, None, None, '{"x":9007199254740993}'), (7, 12, None, None, None)]


def test_a_wider_value_in_a_later_file_is_kept(spark, dirs):
    _land(spark, dirs, "a.json", [{"id": 1, "items": [{"price": 249}]}])
    out = _rows(_land(spark, dirs, "b.json", [{"id": 2, "items": [{"price": 249.5}, {"price": 1}]}]), "id", "items")
    assert out[0] == (1, [(249,)], None)
    assert out[1] == (2, [(None,), (1,)], '{"items":[{"price":249.5},{"price":1}]}')


def test_unknown_nested_keys_are_rescued(spark, dirs):
    _land(spark, dirs, "a.json", [{"id": 1, "items": [{"p": 1}]}])
    out = _rows(_land(spark, dirs, "b.json", [{"id": 2, "items": [{"p": 2, "note": "n"}]}]), "id", "items")
    assert out == [(1, [(1,)], None), (2, [(2,)], '{"items":[{"note":"n","p":2}]}')]


def test_a_type_no_value_has_shown_stays_open(spark, dirs):
    first = _land(spark, dirs, "a.json", [{"id": 1, "items": [], "n": None}])
    assert "items" not in first.columns
    out = _land(spark, dirs, "b.json", [{"id": 2, "items": [{"p": 2}]}])
    assert dict(out.dtypes)["items"] == "array<struct<p:bigint>>"
    assert out.filter("id = 2").select("items").first()[0] == [(2,)]


def test_awkward_names(spark, dirs):
    row = {"id": 1, "user.age": 5, "p": {}, "VOID": "v", "a`b": 1.5, "q'z": [{"x:y": 1}], "DECIMAL(1,2)": 2}
    out = _land(spark, dirs, "a.json", [row])
    got = out.select("id", "`user.age`", "p", "VOID", "`a``b`", "`DECIMAL(1,2)`", "_rescued_data").first()
    assert tuple(got) == (1, 5, "{}", "v", 1.5, 2, None)
    again = _land(spark, dirs, "b.json", [dict(row, id=2)], retries=0)  # no new fields
    assert again.count() == 2 and len(SchemaStore(spark, dirs["state"]).versions()) == 1


def test_hints_and_accepted_schemas_after_the_first_version(spark, dirs):
    _land(spark, dirs, "a.json", [{"id": 1}], IngestOptions(evolution_mode="failOnNewColumns"), retries=0)
    with pytest.raises(Exception, match="new fields"):
        _land(spark, dirs, "b.json", [{"id": 2, "z": 3}], IngestOptions(evolution_mode="failOnNewColumns"), retries=0)
    assert SchemaStore(spark, dirs["state"]).accept("id BIGINT, z BIGINT") == 1
    with pytest.raises(ValueError, match="another type"):
        SchemaStore(spark, dirs["state"]).accept("id DOUBLE, z BIGINT")
    out = _land(spark, dirs, "c.json", [{"id": 3, "z": 4}],
                IngestOptions(evolution_mode="failOnNewColumns", schema_hints="w DATE"), retries=0)
    assert sorted(out.select("id", "z").collect()) == [(1, None), (2, 3), (3, 4)] and "w" in out.columns
    with pytest.raises(Exception, match="another type"):
        _land(spark, dirs, "d.json", [{"id": 4}], IngestOptions(schema_hints="id DOUBLE"), retries=0)


def _forget_last_commit(state):
    commits = f"{state}/commits"
    last = max((n for n in os.listdir(commits) if n.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        if os.path.exists(f"{commits}/{name}"):
            os.remove(f"{commits}/{name}")


RULES_ROW = {"order_id": "o1", "store_id": "s", "channel": "KIOSK", "payment_method": "c", "customer_id": "u",
             "order_ts": "2026-01-02T03:04:05", "currency": "INR", "order_total": 10.0,
             "items": [{"item_id": "i", "item_name": "n", "qty": 1, "unit_price": 10.0}]}


def test_replayed_batches_add_nothing(spark, dirs):
    """Bronze, silver and the counts of the rules, each with its last commit forgotten."""
    opts = IngestOptions(schema_hints="order_total DOUBLE, order_ts TIMESTAMP")
    log = EventLog(spark, f"{dirs['out']}/log")

    def silver():
        run_silver(spark, stream_bronze(spark, dirs["bronze"], dirs["state"], opts), dirs["silver"],
                   f"{dirs['state']}/silver", log=log)
        return spark.read.parquet(dirs["silver"]).count()

    _land(spark, dirs, "a.json", [RULES_ROW], opts)
    assert silver() == 1
    _forget_last_commit(f"{dirs['state']}/checkpoint")
    ingest(spark, dirs["landing"], dirs["bronze"], dirs["state"], opts)
    assert read_bronze(spark, dirs["bronze"], dirs["state"], opts).count() == 1 and silver() == 1
    _forget_last_commit(f"{dirs['state']}/silver")
    storage.delete(spark, f"{dirs['silver']}/batch_id=0")  # as if the run had died before the batch showed
    assert silver() == 1
    passed = log.expectation_results().groupBy("expectation").agg(F.sum("passed").alias("n")).collect()
    assert {r["n"] for r in passed} == {1}
    with pytest.raises(RuntimeError, match="another checkpoint"):
        ingest(spark, dirs["landing"], dirs["bronze"], f"{dirs['state']}-new", opts)


@pytest.mark.parametrize("mode", ["append", "complete", "update"])
def test_live_sink_replay(spark, dirs, mode):
    rows = [{"ts": f"2026-01-0{d} 10:00:00", "k": k, "v": 1.5} for d in (1, 2, 3, 9) for k in "ab"]
    write_lines(dirs["landing"], "a.json", map(json.dumps, rows))
    for _ in range(2):
        stream = spark.readStream.schema("ts TIMESTAMP, k STRING, v DOUBLE").json(dirs["landing"])
        agg = live.daily_window_agg(stream, ts_col="ts", keys=("k",), amount_col="v")
        live.start(agg, name=f"r_{mode}_{time.time_ns()}", checkpoint=f"{dirs['out']}/cp", sink="parquet",
                   path=f"{dirs['out']}/t", output_mode=mode, trigger={"availableNow": True}).awaitTermination()
        out = live.read_result(spark, f"{dirs['out']}/t", mode, ["order_date", "k"]).collect()
        assert len(out) == (6 if mode == "append" else 8) and all(r["orders"] == 1 for r in out)
        _forget_last_commit(f"{dirs['out']}/cp")


def test_gold_follows_the_stream_in_continuous_mode(spark, dirs):
    stores = spark.createDataFrame([("s", "n", "c", "r")], "store_id string, store_name string, city string, region string")
    menu = spark.createDataFrame([("i", "n", "c")], "item_id string, item_name string, category string")
    p = order_pipeline(spark, dirs["out"], dirs["landing"], stores, menu)
    write_lines(dirs["landing"], "a.json", [json.dumps(RULES_ROW)])
    ctx = p.run_update(trigger={"processingTime": "1 second"})
    try:
        write_lines(dirs["landing"], "b.json", [json.dumps(dict(RULES_ROW, order_id="o2"))])
        shown, until = None, time.time() + 120
        while shown != 2 and time.time() < until:  # no further run_update
            for q in ctx.queries:
                q.processAllAvailable()
            refreshed = p.log.read().filter("message like 'View%'").count()
            if refreshed >= 6:  # three views, twice
                shown = p.table("gold_channel_mix").agg(F.sum("orders")).first()[0]
            time.sleep(1)
        assert shown == 2
    finally:
        for q in ctx.queries:
            q.stop()
    assert sorted(p.reset()) == ["_state", "tables"]
    p.run_update()
    assert p.table("gold_channel_mix").agg(F.sum("orders")).first()[0] == 2


def test_python_and_sql_agree_on_a_key_with_several_rows(spark):
    lines = spark.createDataFrame([("2026-01-01", "s", "o", 1, 10.0)],
                                  "order_date string, store_id string, order_id string, qty bigint, line_amount double")
    stores = spark.createDataFrame([("s", "b", "c", "r"), ("s", "a", "c", "r")],
                                   "store_id string, store_name string, city string, region string")
    a = gold.daily_store_sales(lines, stores).collect()
    b = gold.sql_view(spark, "gold_daily_store_sales", lines, stores).select(*gold.DAILY_STORE_SALES).collect()
    assert a == b and len(a) == 1 and (a[0]["store_name"], a[0]["revenue"]) == ("a", 10.0)


def test_changes_read_under_the_schema(spark, dirs):
    from strata.plans.pipeline import table_changes

    _land(spark, dirs, "a.json", [{"id": 1}])
    _land(spark, dirs, "b.json", [{"id": 2, "z": 1}])
    schema = bronze_schema(spark, dirs["state"])
    assert [r["id"] for r in table_changes(spark, dirs["bronze"], 1, schema=schema).collect()] == [2]
