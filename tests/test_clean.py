"""Cleaning rules on the hand-made documents of FIXTURES.md §4 (compared as values)."""

import json

from spanload.operators import clean

DOCS = [
    ('{"_id":"65a","n":null,"a":1}', {"id": "65a", "a": 1}, None),
    ('{"r":[null],"e":[],"q":[null,null]}', {"e": [], "q": [None, None]}, None),
    ('{"items":[{"_id":1},{"_id":2}]}', {"items": [{"id": 1}, {"id": 2}]}, None),
    ('{"b":{"y":2,"_id":"q","a":null}}', {"b": '{"_id":"q","a":null,"y":2}'}, None),
    ('{"b":[1,2]}', {"b": [1, 2]}, None),
    ('{"txt":"say \\"_id\\": x"}', {"txt": 'say "_id": x'}, None),
    ('{bad', None, "undecodable"),
    ('{"_id":"1","id":"2"}', None, "duplicate id"),
    ('{"x":NaN}', None, "non-finite number"),
    ('{"a":1,"a":2}', None, "duplicate key"),
    ('[1,2]', None, "not an object"),
    ('{"w":[null,1],"d":{"k":null}}', {"w": [None, 1], "d": {"k": None}}, None),
]


def test_fixture_documents(spark):
    df = spark.createDataFrame([(i, d) for i, (d, _, _) in enumerate(DOCS)], "i int, doc string")
    out = {r["i"]: r for r in clean.clean_documents(df, string_fields=["b"]).collect()}
    for i, (_, want, reason) in enumerate(DOCS):
        row = out[i]
        assert row["reject_reason"] == reason, (i, row)
        if want is None:
            assert row["line"] is None
        else:
            got = json.loads(row["line"])
            assert got == want, (i, got)


def test_rename_switch_off(spark):
    df = spark.createDataFrame([('{"_id":"1","id":"2"}',)], "doc string")
    row = clean.clean_documents(df, rename_id=False).first()
    assert row["reject_reason"] is None
    assert json.loads(row["line"]) == {"_id": "1", "id": "2"}


def test_reject_counts_and_split(spark):
    df = spark.createDataFrame([(d,) for d, _, _ in DOCS], "doc string")
    cleaned = clean.clean_documents(df, string_fields=["b"])
    good, bad = clean.split_rejects(cleaned)
    assert good.count() == 7 and bad.count() == 5
    counts = {r["outcome"]: r["docs"] for r in clean.reject_counts(cleaned).collect()}
    assert counts["ok"] == 7 and counts["undecodable"] == 1


def test_typed_rows_nonfinite(spark):
    df = spark.createDataFrame(
        [(1, 1.0, [1.0]), (2, float("nan"), [1.0]), (3, 2.0, [float("inf")]), (4, None, None)],
        "k int, v double, a array<double>")
    out = {r["k"]: r for r in clean.rows_to_documents(df, keep=["k"]).collect()}
    assert out[1]["reject_reason"] is None and json.loads(out[1]["doc"])["v"] == 1.0
    assert out[2]["reject_reason"] == "non-finite number" and out[2]["doc"] is None
    assert out[3]["reject_reason"] == "non-finite number"
    assert json.loads(out[4]["doc"]) == {"k": 4, "v": None, "a": None}


def test_nested_duplicate_id_is_rejected(spark):
    docs = ['{"_id":"1","a":{"_id":2,"id":3}}', '{"_id":"1","a":{"id":3},"b":{"_id":4}}']
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, doc string")
    out = {r["i"]: r for r in clean.clean_documents(df).collect()}
    assert out[0]["reject_reason"] == "duplicate id" and out[0]["line"] is None
    assert out[1]["reject_reason"] is None
    assert json.loads(out[1]["line"]) == {"id": "1", "a": {"id": 3}, "b": {"id": 4}}


def _parses(df):
    """Parsing expressions in the optimized plan."""
    import re
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return len(re.findall(r"parse_?json|from_json|jsontostructs", plan.lower()))


def test_filters_do_not_copy_the_parsing(spark):
    from spanload.operators import conform
    docs = spark.createDataFrame([('{"a":1}',), ('{"a":',), ('[1]',)], "doc string").repartition(1)
    cleaned = clean.clean_documents(docs)
    n = _parses(cleaned)
    assert n <= 4  # the document once, and three that only failed or doubtful ones come to
    for narrowed in (cleaned.where("reject_reason is null"), cleaned.where("reject_reason = 'undecodable'").select("doc"),
                     cleaned.where("line like '%a%' and reject_reason is null").select("line")):
        assert _parses(narrowed) <= n
    schema = conform.schema_from_spec([{"name": "a", "type": "INTEGER", "mode": "REQUIRED"}, {"name": "b", "type": "STRING"}])
    typed = conform.conform_lines(cleaned.where("reject_reason is null").drop("reject_reason"), schema)
    m = _parses(typed)
    assert m <= n + 3  # the line, and its texts with brackets by field
    assert _parses(typed.where("reject_reason is null").select("a")) <= m
    assert sorted((r["doc"], r["reject_reason"]) for r in cleaned.where("line is null").collect()) == [
        ("[1]", "not an object"), ('{"a":', "undecodable")]


def test_only_inputs_below_a_split_a_core_are_spread(spark, tmp_path):
    from spanload.session import spread
    spark.range(1000).coalesce(1).write.parquet(f"{tmp_path}/t")
    small = spark.read.parquet(f"{tmp_path}/t")
    assert spread(small).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "128")
    try:
        assert "Exchange" not in spread(small)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
