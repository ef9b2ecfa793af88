"""The typed fast path loads exactly what the JSON document path loads."""

import json

import pytest
from pyspark.sql import functions as F

from spanload.operators import conform
from spanload.plans import load
from spanload.plans.load_checks import fresh_warehouse
from spanload.sources.specs import spec_from_text
from spanload.sources.tables import read_table
from tests.conftest import SF001


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", ["lineitem", "orders", "conversations", "labels", "documents"])
def test_same_table_both_ways(spark, name):
    src = read_table(spark, SF001, name)
    spec = spec_from_text(f"{name}.json", json.dumps(load.typed_schema_spec(src.schema)))
    assert conform.typed_compatible(src.schema, spec.schema)
    out = {}
    for fast in (True, False):
        wh = fresh_warehouse(spark, f"t-typed-{fast}")
        r = load.load_table(spark, src, spec, wh, load.LoadOptions(
            key=src.columns[0], method="count", typed_fast_path=fast, rename_id=False))
        assert r.status == "ok" and r.rejects == 0
        out[fast] = _rows(spark.table(wh.name(spec.table)))
    assert out[True] == out[False]


def test_float32_goes_through_json(spark):
    src = read_table(spark, SF001, "embeddings")
    spec = spec_from_text("e.json", json.dumps(load.typed_schema_spec(src.schema)))
    assert not conform.typed_compatible(src.schema, spec.schema)


def test_typed_rules(spark):
    df = spark.createDataFrame(
        [("a", 1, [None], 1.5, None), ("b", None, ["x", None], float("nan"), "12:00:00"),
         ("c", 3, ["y"], 2.0, "99:00:00"), (None, 4, None, 0.0, None)],
        "_id string, n int, tags array<string>, v double, t string")
    schema = conform.schema_from_spec([
        {"name": "id", "type": "STRING", "mode": "REQUIRED"},
        {"name": "n", "type": "INTEGER"},
        {"name": "tags", "type": "STRING", "mode": "REPEATED"},
        {"name": "v", "type": "FLOAT"},
        {"name": "t", "type": "TIME"},
        {"name": "missing", "type": "STRING", "mode": "REPEATED"}])
    assert conform.typed_compatible(df.schema, schema)
    got = {r["id"]: r for r in conform.conform_typed(df, schema).collect()}
    assert got["a"]["reject_reason"] is None and got["a"]["tags"] == [] \
        and got["a"]["missing"] == []
    assert got["b"]["reject_reason"] == "non-finite number"
    assert got["c"]["reject_reason"] == "bad time value: t"
    assert got[None]["reject_reason"] == "required field missing: id"
    bad = spark.createDataFrame([(1,)], "quality int")
    assert not conform.typed_compatible(
        bad.schema, conform.schema_from_spec([{"name": "quality", "type": "BOOLEAN"}]))
    with pytest.raises(Exception, match="load failed"):
        conform.conform_typed(df.where(F.col("_id") == "c"), schema, on_bad="fail").count()
