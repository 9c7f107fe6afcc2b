import json
import os
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests import synth
from strata.sources.files import list_files
from strata.sources.ingest import IngestOptions, UnknownFieldError, ingest, read_bronze
from strata.sources.schema_store import SchemaStore
from tests.conftest import write_lines

HINTS = "order_total DOUBLE, order_ts TIMESTAMP"


def run(spark, d, opts, **kw):
    return ingest(spark, d["landing"], d["bronze"], d["state"], opts, **kw)


def bronze(spark, d, opts=None):
    return read_bronze(spark, d["bronze"], d["state"], opts)


def test_staged_batches_fail_once_then_exactly_once(spark, dirs):
    opts = IngestOptions(schema_hints=HINTS)
    batches = synth.staged_batches(spark)
    for name, df in batches[:2]:
        synth.write_batch(df, dirs["landing"], name)
    run(spark, dirs, opts)
    assert bronze(spark, dirs).count() == 220
    run(spark, dirs, opts)  # re-run, no new files
    assert bronze(spark, dirs).count() == 220
    synth.write_batch(batches[2][1], dirs["landing"], batches[2][0])
    with pytest.raises(StreamingQueryException, match=UnknownFieldError.MARKER):
        run(spark, dirs, opts)
    assert bronze(spark, dirs).count() == 220  # the failed run committed nothing
    run(spark, dirs, opts)  # same batch replays with the wider schema
    b = bronze(spark, dirs)
    assert b.count() == 370
    versions = SchemaStore(spark, dirs["state"]).versions()
    assert [v for v, _ in versions] == [0, 1]
    assert {"loyalty_id", "promo_code"} <= set(versions[1][1].fieldNames())
    assert dict(b.schema.fields and [(f.name, f.dataType.simpleString()) for f in b.schema.fields])["order_ts"] == \
        "timestamp"
    early = b.filter(F.col("batch_id") == 0).agg(F.count("loyalty_id"), F.count("promo_code")).first()
    assert tuple(early) == (0, 0)
    late = b.filter(F.col("batch_id") == 1).agg(F.count("*"), F.count("loyalty_id"), F.count("promo_code")).first()
    assert late[0] == 150 and 0.45 < late[1] / 150 < 0.75 and 0.12 < late[2] / 150 < 0.38
    for name, df in batches[3:]:
        synth.write_batch(df, dirs["landing"], name)
    run(spark, dirs, opts, retries=1)
    assert bronze(spark, dirs).count() == 640
    assert bronze(spark, dirs).filter(F.col("_rescued_data").isNotNull()).count() == 0
    assert list_files(spark, dirs["landing"], "*.json").count() == 5


def test_rescue_edge_cases(spark, dirs):
    lines = [
        json.dumps({"order_id": "A", "order_total": 10.5, "items": [{"item_id": "I", "qty": 1}]}),
        "{bad", "[1,2]", "3", '{"order_id": "X", "order_id": "Y"}',
        json.dumps({"order_id": "B", "order_total": "abc", "items": [{"item_id": "I", "qty": 2}]}),
        json.dumps({"order_id": "C", "order_total": "10.5", "items": [{"item_id": "I", "qty": "x"}]}),
        json.dumps({"order_id": "D", "order_total": 1.0, "items": [], "surprise": {"a": 1}}),
        "",
    ]
    write_lines(dirs["landing"], "f1.json", lines)
    schema = "order_id STRING, order_total DOUBLE, items ARRAY<STRUCT<item_id: STRING, qty: BIGINT>>"
    opts = IngestOptions(schema=schema, evolution_mode="rescue")
    run(spark, dirs, opts)
    got = {r.order_id or r._rescued_data: r for r in bronze(spark, dirs, opts).collect()}
    assert len(got) == 8  # the blank line is skipped
    for raw in ("{bad", "[1,2]", "3", '{"order_id": "X", "order_id": "Y"}'):  # duplicate keys: not parsed
        assert got[raw]._rescued_data == raw and got[raw].order_id is None  # whole line kept
    assert got["A"]._rescued_data is None and got["A"].order_total == 10.5
    assert got["B"].order_total is None and json.loads(got["B"]._rescued_data) == {"order_total": "abc"}
    assert got["C"].order_total == 10.5  # numeric string is cast, not rescued (H3)
    assert json.loads(got["C"]._rescued_data) == {"items": [{"item_id": "I", "qty": "x"}]}  # nested mismatch (H2)
    assert json.loads(got["D"]._rescued_data) == {"surprise": {"a": 1}}  # rescue mode: unknown key kept


def test_fail_on_new_columns_and_none_modes(spark, dirs, tmp_path):
    write_lines(dirs["landing"], "a.json", [json.dumps({"id": 1, "v": "x"})])
    opts = IngestOptions(evolution_mode="failOnNewColumns")
    run(spark, dirs, opts)
    write_lines(dirs["landing"], "b.json", [json.dumps({"id": 2, "v": "y", "w": 5})])
    for _ in range(2):  # keeps failing: no new version is written
        with pytest.raises(StreamingQueryException, match=UnknownFieldError.MARKER):
            run(spark, dirs, opts)
    assert [v for v, _ in SchemaStore(spark, dirs["state"]).versions()] == [0]

    d2 = {k: str(tmp_path / ("n_" + k)) for k in ("landing", "bronze", "state")}
    write_lines(d2["landing"], "a.json", [json.dumps({"id": 1})])
    none = IngestOptions(evolution_mode="none")
    run(spark, d2, none)
    write_lines(d2["landing"], "b.json", [json.dumps({"id": 2, "w": 5})])
    run(spark, d2, none)
    b = read_bronze(spark, d2["bronze"], d2["state"], none)
    assert b.count() == 2 and "w" not in b.columns
    assert b.filter(F.col("_rescued_data").isNotNull()).count() == 0


def test_inference_without_types_and_hints(spark, dirs):
    write_lines(dirs["landing"], "a.json", [json.dumps({"n": 1, "x": 2.5, "o": {"k": 1}, "t": "2026-08-01T10:00:00"})])
    opts = IngestOptions(infer_column_types=False, schema_hints="t TIMESTAMP, extra INT")
    run(spark, dirs, opts)
    s = {f.name: f.dataType.simpleString() for f in bronze(spark, dirs, opts).schema.fields}
    assert (s["n"], s["x"], s["o"], s["t"], s["extra"]) == ("string", "string", "string", "timestamp", "int")
    r = bronze(spark, dirs, opts).first()
    assert r.n == "1" and json.loads(r.o) == {"k": 1}


def test_max_files_per_trigger_and_old_files(spark, dirs):
    now = time.time()
    write_lines(dirs["landing"], "new.json", [json.dumps({"id": 1})], mtime=now)
    write_lines(dirs["landing"], "old.json", [json.dumps({"id": 2})], mtime=now - 30 * 86400)  # H8
    write_lines(dirs["landing"], "mid.json", [json.dumps({"id": 3})], mtime=now - 86400)
    opts = IngestOptions(max_files_per_trigger=1)
    run(spark, dirs, opts)
    b = bronze(spark, dirs, opts)
    assert sorted(r.id for r in b.collect()) == [1, 2, 3]
    assert b.select("batch_id").distinct().count() == 3  # one file per micro-batch
    assert all(os.path.basename(r.source_file).endswith(".json") for r in b.collect())



def test_lines_written_back_alike_need_no_second_look(spark, dirs, monkeypatch):
    """A batch whose lines show by themselves that they fit is read once: no inference over all, no search for new keys,
    and nothing held in memory."""
    def must_not(*_, **__):
        raise AssertionError("the batch was read again")

    monkeypatch.setattr("strata.sources.ingest.new_top_level_keys", must_not)
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.persist", must_not)
    line = '{"order_id":"%d","order_ts":"2026-08-01T10:00:00.000Z","items":[{"qty":%d,"unit_price":2.5}],"order_total":3.25}'
    for batch in range(2):
        write_lines(dirs["landing"], f"{batch}.json", [line % (i, i + batch) for i in range(20)])
        run(spark, dirs, IngestOptions(schema_hints=HINTS))
    b = bronze(spark, dirs)
    assert b.count() == 40 and b.filter(F.col("_rescued_data").isNotNull()).count() == 0
    assert b.agg(F.sum(F.col("items")[0]["qty"]), F.min(F.col("order_ts").cast("string"))).first()[:] == \
        (400, "2026-08-01 10:00:00")


def test_reading_lines_whole_changes_no_value(spark, tmp_path):
    """Every line has the same bronze row whether it is read whole or taken apart as VARIANT."""
    lines = ['{"s":"a","n":1,"x":1.5,"b":true,"t":"2026-08-01T10:00:00.000Z","l":[{"q":1,"p":2.5}]}', '{}', '{"s":"5"}',
             '{"s":5}', '{"s":1.50}', '{"n":"5"}', '{"n":1.0}', '{"n":9223372036854775808}', '{"x":5}', '{"x":-0.0}',
             '{"x":"NaN"}', '{"x":"Infinity"}', '{"x":1.0E10}', '{"x":12345678.25}', '{"x":0.1234567890123456789}',
             '{"x":9007199254740993}', '{"b":"true"}', '{"b":1}', '{"t":"2026-08-01"}', '{"t":"x"}', '{"t":5}',
             '{"t":"2026-08-01T10:00:00.0000001Z"}', '{"t":null}', '{"s":null,"n":1}', '{"l":[]}', '{"l":[null]}',
             '{"l":[{}]}', '{"l":[{"q":"1","p":1.5}]}', '{"l":[{"q":1,"r":2}]}', '{"l":{"q":1}}', '{"u":1}', '{"S":"a"}',
             '{"s":"a","s":"b"}', '{"s":"a"} ', ' {"s":"a"}', '{"n":1,"s":"a"}', '{"s":"a"}x', '{"s":"é\\u00e9\\n/"}',
             '{"s":{"k":1}}', '{"s":[1]}', '[1]', '5', 'x', '"s"', '{"s":"a"', '{"x":1e400}', '{"n":-0}', '{"l":[{"p":-0.0}]}']
    path = write_lines(str(tmp_path), "lines.json", lines)
    from strata.sources import ingest as module
    schema = module.T.StructType.fromDDL("s string, n bigint, x double, b boolean, t timestamp, "
                                         "l array<struct<q: bigint, p: double>>")
    raw = spark.read.text(path).select(F.col("value").alias(module.LINE), F.lit("f").alias(module.SRC),
                                       F.current_timestamp().alias(module.MTIME))

    def rows(order, seen=None):
        return [str(r[:-2]) for r in module.project(raw, schema, IngestOptions(), order, seen).collect()]

    seen = module.Observation("seen")
    whole = rows(["s", "n", "x", "b", "t", "l"], seen)
    parsed = seen.get["parsed"]
    assert len(whole) == len(lines) and 20 < parsed < len(lines) - 5
    says_all = module.says_all
    try:
        module.says_all = lambda *_: F.lit(False)
        assert rows([]) == whole
    finally:
        module.says_all = says_all


def test_a_late_line_decides_the_first_schema(spark, dirs, monkeypatch):
    """The first batch's schema is that of all its lines, however few of them the sample has."""
    monkeypatch.setattr("strata.sources.ingest.SAMPLE_LINES", 2)
    write_lines(dirs["landing"], "a.json", ['{"a":1,"b":"x"}'] * 5 + ['{"a":1.5,"b":"x","c":true}', '{"a":2,"b":{"k":1}}'])
    run(spark, dirs, IngestOptions())
    b = bronze(spark, dirs)
    assert [(f.name, f.dataType.simpleString()) for f in b.schema.fields][:3] == \
        [("a", "double"), ("b", "string"), ("c", "boolean")]
    assert b.count() == 7 and b.agg(F.sum("a"), F.count("c")).first()[:] == (8.5, 1)
    assert [v for v, _ in SchemaStore(spark, dirs["state"]).versions()] == [0]
