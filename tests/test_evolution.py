"""Fields that appear inside stored objects: fail once, one more version, nothing lost."""

import json

import pytest
from pyspark.errors import StreamingQueryException
from strata.sources.ingest import IngestOptions, ingest, read_bronze
from strata.sources.schema_store import SchemaStore
from tests.conftest import write_lines

NESTED = IngestOptions(evolve_nested=True)


def _land(spark, d, name, rows, opts=NESTED, retries=0):
    write_lines(d["landing"], name, [r if isinstance(r, str) else json.dumps(r) for r in rows])
    ingest(spark, d["landing"], d["bronze"], d["state"], opts, retries=retries)
    return read_bronze(spark, d["bronze"], d["state"], opts)


def _versions(spark, d):
    return [s.simpleString() for _, s in SchemaStore(spark, d["state"]).versions()]


def test_nested_fields_fail_once_and_land(spark, dirs):
    _land(spark, dirs, "a.json", [{"id": 1, "a": {"x": 1}, "items": [{"p": 1, "deep": [{"m": 1}]}]}])
    later = [{"id": 2, "a": {"x": 1, "y": 2}}, {"id": 3, "items": [{"p": 2}, {"p": 3, "note": "n", "deep": [{"m": 2, "u": 2.5}]}]},
             {"id": 4, "a": "text"}, {"id": 5, "a": {"x": "no", "y": 7}, "items": [7, None]}, "{bad", {"id": 6, "a": None}]
    with pytest.raises(StreamingQueryException, match=r"'a\.y', 'items\[\]\.deep\[\]\.u', 'items\[\]\.note'"):
        _land(spark, dirs, "b.json", later)
    assert read_bronze(spark, dirs["bronze"], dirs["state"], NESTED).count() == 1  # the failed run committed nothing
    assert len(_versions(spark, dirs)) == 2
    ingest(spark, dirs["landing"], dirs["bronze"], dirs["state"], NESTED)  # the same batch under the wider schema
    out = {r["id"]: r for r in read_bronze(spark, dirs["bronze"], dirs["state"], NESTED).collect()}
    assert len(out) == 7
    assert out[1]["a"].asDict() == {"x": 1, "y": None}
    assert out[1]["items"][0].asDict(True) == {"p": 1, "note": None, "deep": [{"m": 1, "u": None}]}
    assert out[2]["a"].asDict() == {"x": 1, "y": 2} and out[2]["_rescued_data"] is None
    assert [i.asDict(True) for i in out[3]["items"]] == [
        {"p": 2, "note": None, "deep": None}, {"p": 3, "note": "n", "deep": [{"m": 2, "u": 2.5}]}]
    assert out[4]["a"] is None and json.loads(out[4]["_rescued_data"]) == {"a": "text"}
    assert out[5]["a"].asDict() == {"x": None, "y": 7}
    assert json.loads(out[5]["_rescued_data"]) == {"a": {"x": "no", "y": 7}, "items": [7, None]}
    assert out[None]["_rescued_data"] == "{bad" and out[6]["_rescued_data"] is None
    assert len(_versions(spark, dirs)) == 2


def test_new_column_and_nested_field_make_one_version(spark, dirs):
    _land(spark, dirs, "a.json", [{"id": 1, "a": {"x": 1}}])
    out = _land(spark, dirs, "b.json", [{"id": 2, "b": {"z": 1}, "a": {"x": 1, "X": 5, "y": {"w": True}}}], retries=1)
    assert _versions(spark, dirs)[1:] == ["struct<a:struct<x:bigint,y:struct<w:boolean>>,id:bigint,b:struct<z:bigint>>"]
    row = out.filter("id = 2").first()
    assert row["a"].asDict(True) == {"x": 1, "y": {"w": True}} and row["b"]["z"] == 1
    assert json.loads(row["_rescued_data"])["a"]["X"] == 5  # differs by case only: no field of its own, but kept


def test_open_and_repeated_names_stay_unknown(spark, dirs):
    _land(spark, dirs, "a.json", [{"id": 1, "a": {"x": 1}, "B": 1, "b": 2}])
    assert _versions(spark, dirs) == ["struct<B:bigint,a:struct<x:bigint>,id:bigint>"]
    out = _land(spark, dirs, "b.json", [{"id": 2, "a": {"x": 2, "n": None, "e": []}}])  # no type shown yet: no failure
    assert len(_versions(spark, dirs)) == 1 and out.count() == 2
    assert json.loads(out.filter("id = 2").first()["_rescued_data"])["a"] == {"x": 2, "n": None, "e": []}
    out = _land(spark, dirs, "c.json", [{"id": 3, "a": {"x": 3, "n": "now", "e": [1]}}], retries=1)
    assert out.filter("id = 3").first()["a"].asDict() == {"x": 3, "e": [1], "n": "now"}


def test_hints_maps_and_fail_mode(spark, dirs, tmp_path):
    hints = "a STRUCT<x: BIGINT>, m MAP<STRING, STRUCT<v: BIGINT>>"
    hinted = IngestOptions(evolve_nested=True, schema_hints=hints)
    rows = [{"id": 1, "a": {"x": 1, "y": 2}, "m": {"k": {"v": 1, "w": 2}}}]
    _land(spark, dirs, "a.json", rows, hinted)
    out = _land(spark, dirs, "b.json", rows, hinted)  # a person has fixed these types
    assert len(_versions(spark, dirs)) == 1 and out.count() == 2
    wider = IngestOptions(evolve_nested=True, schema_hints="a STRUCT<x: BIGINT, y: BIGINT>")
    out = _land(spark, dirs, "c.json", rows, wider, retries=1)  # a wider hint holds; the map, no longer hinted, evolves
    last = out.orderBy("batch_id").collect()[-1]
    assert last["a"].asDict() == {"x": 1, "y": 2} and last["m"]["k"].asDict() == {"v": 1, "w": 2}
    d = {k: str(tmp_path / ("f_" + k)) for k in ("landing", "bronze", "state")}
    strict = IngestOptions(evolve_nested=True, evolution_mode="failOnNewColumns")
    _land(spark, d, "a.json", [{"id": 1, "a": {"x": 1}}], strict)
    with pytest.raises(StreamingQueryException, match=r"a\.y"):
        _land(spark, d, "b.json", [{"id": 2, "a": {"y": 1}}], strict)
    assert len(_versions(spark, d)) == 1
