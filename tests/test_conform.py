import pytest
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from spanload.operators import conform
from spanload.plans.load_checks import USERS_SCHEMA


def test_users_schema():
    s = conform.schema_from_spec(USERS_SCHEMA)
    assert [f.name for f in s.fields] == ["id", "username", "test_user", "account_details",
                                          "created_at"]
    ad = s["account_details"].dataType
    assert isinstance(ad, ArrayType) and isinstance(ad.elementType, StructType)
    assert ad.elementType["age"].dataType == LongType()
    assert s["id"].metadata["description"] == "key of the user"
    assert conform.string_fields(s) == ["id", "username"]


def test_schema_errors():
    with pytest.raises(conform.SchemaError, match="empty"):
        conform.schema_from_spec([])
    with pytest.raises(conform.SchemaError, match="unsupported type"):
        conform.schema_from_spec([{"name": "g", "type": "GEOGRAPHY"}])
    with pytest.raises(conform.SchemaError, match="no fields"):
        conform.schema_from_spec([{"name": "r", "type": "RECORD"}])
    with pytest.raises(conform.SchemaError, match="invalid schema JSON"):
        conform.schema_from_spec("[{")


def test_case_insensitive_types():
    s = conform.schema_from_spec([{"name": "a", "type": "string", "mode": "required"}])
    assert s["a"].dataType == StringType() and not s["a"].nullable


def test_load_rules(spark):
    schema = conform.schema_from_spec([
        {"name": "id", "type": "STRING", "mode": "REQUIRED"},
        {"name": "n", "type": "INTEGER"},
        {"name": "t", "type": "TIME"},
        {"name": "xs", "type": "RECORD", "mode": "REPEATED",
         "fields": [{"name": "a", "type": "INTEGER", "mode": "REQUIRED"},
                    {"name": "ys", "type": "STRING", "mode": "REPEATED"}]}])
    lines = [
        '{"id":"1","n":5,"t":"12:30:00","xs":[{"a":1,"ys":["p"]}],"extra":true}',
        '{"id":"2"}',
        '{"n":5}',
        '{"id":"4","n":"abc"}',
        '{"id":"5","t":"25:00:00"}',
        '{"id":"6","xs":[{"ys":["q"]}]}',
        '{"id":"7","xs":[{"a":2}]}',
    ]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    out = {r["i"]: r for r in conform.conform_lines(df, schema, keep=["i"]).collect()}
    assert out[0]["reject_reason"] is None and out[0]["n"] == 5
    assert out[1]["reject_reason"] is None and out[1]["xs"] == []
    assert out[2]["reject_reason"] == "required field missing: id"
    assert out[3]["reject_reason"] == "bad value"
    assert out[4]["reject_reason"] == "bad time value: t"
    assert out[5]["reject_reason"] == "required field missing: xs.a"
    assert out[6]["reject_reason"] is None and out[6]["xs"][0]["ys"] == []


def test_arrays_and_records_are_not_text(spark):
    schema = conform.schema_from_spec([
        {"name": "s", "type": "STRING"},
        {"name": "l", "type": "STRING", "mode": "REPEATED"},
        {"name": "r", "type": "RECORD", "fields": [{"name": "t", "type": "STRING"}]},
        {"name": "xs", "type": "RECORD", "mode": "REPEATED",
         "fields": [{"name": "n", "type": "INTEGER"}, {"name": "u.v", "type": "STRING"}]}])
    good = ['{"s":"[1,2]","l":["{","[x]"],"r":{"t":"{\\"a\\":1}"},"xs":[{"u.v":"[]"}]}', '{"s":5,"r":{"t":true}}',
            '{"s":null,"l":[],"xs":[]}', '{"r":{}}', '{"s":"","extra":[1]}']
    bad = ['{"s":[1,2]}', '{"s":{"a":1}}', '{"s":[]}', '{"l":["a",["b"]]}', '{"l":[{"a":1}]}', '{"r":{"t":[1]}}',
           '{"r":{"t":{"a":1}}}', '{"xs":[{"u.v":"a"},{"u.v":{"b":1}}]}']
    df = spark.createDataFrame([(i, x) for i, x in enumerate(good + bad)], "i int, line string")
    out = {r["i"]: r["reject_reason"] for r in conform.conform_lines(df, schema, keep=["i"]).collect()}
    assert [out[i] for i in range(len(good + bad))] == [None] * len(good) + ["bad value"] * len(bad)


def test_fail_mode_raises(spark):
    schema = conform.schema_from_spec([{"name": "n", "type": "INTEGER"}])
    df = spark.createDataFrame([('{"n":"x"}',)], "line string")
    with pytest.raises(Exception, match="load failed: bad value"):
        conform.conform_lines(df, schema, on_bad="fail").drop("reject_reason").select("n").collect()
