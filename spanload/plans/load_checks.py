"""Checked queries for schema conformance, export, publish and batch runs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanload.functions.names import normalize_table_name_col, source_name_col
from spanload.operators import clean, conform, export, publish, splits
from spanload.plans import batch, load
from spanload.plans.clean_checks import (OUTCOME, STRING_FIELDS, with_raw_doc,
                                         cleaned_documents)
from spanload.plans.registry import register
from spanload.plans.split_checks import assigned, sp_count, sp_time, with_src
from spanload.session import materialize, scratch_path, spread
from spanload.sources import ranges as range_files
from spanload.sources.specs import TableSpec, discover_specs, spec_from_text
from spanload.sources.tables import TABLES, events_with_key, read_table

# The example table schema of the reference's configuration
# (a user table with a repeated record).
USERS_SCHEMA = [
    {"name": "id", "type": "STRING", "description": "key of the user"},
    {"name": "username", "type": "STRING",
     "description": "login name, no two alike"},
    {"name": "test_user", "type": "BOOLEAN", "description": "made for tests"},
    {"name": "account_details", "type": "RECORD", "mode": "REPEATED",
     "description": "one entry an account",
     "fields": [{"name": "name", "type": "STRING"},
                {"name": "age", "type": "INTEGER"},
                {"name": "score", "type": "FLOAT"}]},
    {"name": "created_at", "type": "TIMESTAMP", "description": "first seen"},
]

# --------------------------------------------------------------------------
# F1–F3 — nested schema: customers as user documents

_USER_DOC = """'{"_id":"' || CAST(c_custkey AS STRING) || '","username":"' || c_name
 || '","test_user":' || CASE WHEN c_mktsegment = 'BUILDING' THEN 'true' ELSE 'false' END
 || ',"account_details":[{"name":"' || c_mktsegment || '","age":' || CAST(c_nationkey AS STRING)
 || ',"score":' || CAST(c_acctbal AS STRING) || '},{"name":"' || c_name || '","age":'
 || CAST(c_custkey % 90 AS STRING) || ',"score":null}],"created_at":'
 || CAST(1700000000 + c_custkey * 37 AS STRING) || ',"extra":{"a":1}}'"""


def user_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = spread(read_table(spark, sf_dir, "customer"))
    return cu.select(F.expr(_USER_DOC).alias("doc"))


@register("conform_nested", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS username, c_mktsegment = 'BUILDING' AS test_user,
       CAST(2 AS INTEGER) AS n_details, CAST(c_nationkey + c_custkey % 90 AS BIGINT) AS age_sum,
       c_acctbal AS first_score, true AS second_score_null,
       CAST(1700000000 + c_custkey * 37 AS BIGINT) AS created_at_sec
FROM customer""")
def q_conform_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 — the nested example schema, REPEATED RECORD included, loads typed rows."""
    schema = conform.schema_from_spec(USERS_SCHEMA)
    cleaned = clean.clean_documents(user_documents(spark, sf_dir), string_fields=conform.string_fields(schema))
    typed = conform.conform_lines(cleaned.where("reject_reason IS NULL").drop("reject_reason"),
                                  schema, on_bad="fail")
    ad = F.col("account_details")
    return typed.select(
        "id", "username", "test_user", F.size(ad).alias("n_details"),
        F.aggregate(ad, F.lit(0).cast("bigint"), lambda acc, x: acc + x["age"]).alias("age_sum"),
        ad[0]["score"].alias("first_score"),
        ad[1]["score"].isNull().alias("second_score_null"),
        F.unix_seconds("created_at").alias("created_at_sec"))


EVENTS_OK = f"SELECT *, {OUTCOME} AS outcome FROM events"
HEX = "(format('{:08x}', epoch_us(ts) // 1000000) || format('{:016x}', event_id))"


def _good_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = clean.split_rejects(cleaned_documents(spark, sf_dir))
    return good


@register("conform_unknown", f"""
SELECT {HEX} AS id, user_id, value FROM ({EVENTS_OK}) WHERE outcome = 'ok'""")
def q_conform_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 — fields the schema does not name are dropped."""
    schema = conform.schema_from_spec([
        {"name": "id", "type": "STRING"}, {"name": "user_id", "type": "INTEGER"},
        {"name": "value", "type": "FLOAT"}])
    return conform.conform_lines(_good_lines(spark, sf_dir), schema, on_bad="fail").drop(
        "reject_reason")


@register("conform_missing", f"""
SELECT event_id, {HEX} AS id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'n' || event_id END AS note,
       CAST(CASE WHEN event_id % 5 = 4 THEN 1 ELSE 0 END AS INTEGER) AS n_tags,
       CASE WHEN event_id % 5 = 4 THEN event_type ELSE '' END AS tags_joined,
       CAST(NULL AS BIGINT) AS missing_int, CAST(0 AS INTEGER) AS n_missing
FROM ({EVENTS_OK}) WHERE outcome = 'ok' AND event_id % 5 NOT IN (2, 3)""")
def q_conform_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3/F6 — a missing field loads as NULL, a missing REPEATED field as []."""
    schema = conform.schema_from_spec([
        {"name": "id", "type": "STRING"}, {"name": "note", "type": "STRING"},
        {"name": "tags", "type": "STRING", "mode": "REPEATED"},
        {"name": "missing_int", "type": "INTEGER"},
        {"name": "missing_list", "type": "INTEGER", "mode": "REPEATED"}])
    typed = conform.conform_lines(_good_lines(spark, sf_dir), schema, keep=["event_id"])
    return (typed.where("reject_reason IS NULL")
            .select("event_id", "id", "note", F.size("tags").alias("n_tags"),
                    F.array_join("tags", ",").alias("tags_joined"), "missing_int",
                    F.size("missing_list").alias("n_missing")))


@register("conform_bad_rows", f"""
SELECT event_id, 'bad value' AS reject_reason FROM ({EVENTS_OK})
WHERE outcome = 'ok' AND event_id % 3 <> 0""")
def q_conform_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 — a value that does not fit its type makes the row bad (here: rejected)."""
    schema = conform.schema_from_spec([
        {"name": "id", "type": "STRING"}, {"name": "note", "type": "INTEGER"}])
    typed = conform.conform_lines(_good_lines(spark, sf_dir), schema, keep=["event_id"])
    return typed.where("reject_reason IS NOT NULL").select("event_id", "reject_reason")


@register("conform_required", f"""
SELECT CASE WHEN event_id % 3 = 0 THEN 'required field missing: note'
            WHEN event_id % 5 IN (2, 3) THEN 'null in repeated field: tags'
            ELSE 'ok' END AS outcome, CAST(count(*) AS BIGINT) AS docs
FROM ({EVENTS_OK}) WHERE outcome = 'ok' GROUP BY 1""")
def q_conform_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5 — REQUIRED must be present; REPEATED must hold no NULL element."""
    schema = conform.schema_from_spec([
        {"name": "id", "type": "STRING", "mode": "REQUIRED"},
        {"name": "note", "type": "STRING", "mode": "REQUIRED"},
        {"name": "tags", "type": "STRING", "mode": "REPEATED"}])
    typed = conform.conform_lines(_good_lines(spark, sf_dir), schema)
    return clean.reject_counts(typed)


@register("conform_kinds", f"""
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'ok' ELSE 'bad value' END AS fits
FROM ({EVENTS_OK}) WHERE outcome = 'ok'""")
def q_conform_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 — an array in a STRING field does not fit; a missing field does."""
    schema = conform.schema_from_spec([{"name": "id", "type": "STRING"}, {"name": "tags", "type": "STRING"}])
    typed = conform.conform_lines(_good_lines(spark, sf_dir), schema, keep=["event_id"])
    return typed.select("event_id", F.coalesce("reject_reason", F.lit("ok")).alias("fits"))


# --------------------------------------------------------------------------
# W2 — part assignment on raw line bytes (one chunk)

DOC_LINE_SQL = ("strlen(to_json({'doc_id': doc_id, 'text': text, 'lang': lang, "
                "'source': source, 'n_chars': n_chars})::VARCHAR) + 1")
CONV_LINE_SQL = "strlen(to_json({'conv_id': conv_id, 'turn': turn, 'role': role, 'text': text})::VARCHAR) + 1"


@register("part_assign", f"""
WITH l AS (SELECT conv_id * 1000 + turn AS key, {CONV_LINE_SQL} AS b FROM conversations),
w AS (SELECT *, coalesce(sum(b) OVER (ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pre FROM l)
SELECT CAST(0 AS INTEGER) AS chunk, CAST(pre // 20000 AS INTEGER) AS part, CAST(count(*) AS BIGINT) AS rows,
       CAST(sum(b) AS BIGINT) AS bytes, min(key) AS min_key, max(key) AS max_key
FROM w GROUP BY 1, 2""")
def q_part_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    cv = read_table(spark, sf_dir, "conversations")
    rows = cv.select((F.col("conv_id") * 1000 + F.col("turn")).alias("key"),
                     F.to_json(F.struct("conv_id", "turn", "role", "text")).alias("line"),
                     F.lit(0).alias("chunk"))
    parted = export.assign_parts(rows, "key", "line", 20000)
    return export.part_report(parted, "key")


@register("part_assign_dups", f"""
WITH l AS (SELECT conv_id * 1000 + turn AS key, {CONV_LINE_SQL} AS b FROM conversations, range(50)),
w AS (SELECT *, coalesce(sum(b) OVER (ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pre FROM l)
SELECT CAST(0 AS INTEGER) AS chunk, CAST(pre // 200000 AS INTEGER) AS part, CAST(count(*) AS BIGINT) AS rows,
       CAST(sum(b) AS BIGINT) AS bytes, min(key) AS min_key, max(key) AS max_key
FROM w GROUP BY 1, 2""")
def q_part_assign_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 — equal lines, 50 of each: cut into parts like others, over many buckets."""
    cv = read_table(spark, sf_dir, "conversations")
    rows = cv.select((F.col("conv_id") * 1000 + F.col("turn")).alias("key"),
                     F.to_json(F.struct("conv_id", "turn", "role", "text")).alias("line"),
                     F.lit(0).alias("chunk"), F.explode(F.sequence(F.lit(1), F.lit(50))).alias("_n")).drop("_n")
    return export.part_report(export.assign_parts(rows, "key", "line", 200_000, bucket_bytes=1 << 20), "key")


HOT_LIMIT = 300_000


@register("part_assign_buckets", f"""
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(sum({DOC_LINE_SQL}) AS BIGINT) AS bytes,
       true AS within_limit, true AS in_key_order FROM documents""")
def q_part_assign_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 — small buckets and a key that a third of the rows have (ordered by a hash that SQL lacks,
    so what is compared are the totals, the limit and the order of the parts)."""
    docs = read_table(spark, sf_dir, "documents")
    rows = docs.select(F.when(F.col("doc_id") % 3 == 0, F.lit(7)).otherwise(F.col("doc_id")).alias("key"),
                       F.to_json(F.struct("doc_id", "text", "lang", "source", "n_chars")).alias("line"),
                       F.lit(0).alias("chunk"))
    parted = materialize(export.assign_parts(rows, "key", "line", HOT_LIMIT, bucket_bytes=64 << 10)
                         .select("chunk", "part", "key", "bytes"))
    longest = parted.agg(F.max("bytes")).first()[0] or 0
    after = F.lead("min_key").over(Window.partitionBy("chunk").orderBy("part"))  # over the parts alone
    return (export.part_report(parted, "key").withColumn("after", after)
            .agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"),
                 F.every(F.col("bytes") < HOT_LIMIT + longest).alias("within_limit"),
                 F.every(F.coalesce(F.col("max_key") <= F.col("after"), F.lit(True))).alias("in_key_order")))


@register("part_assign_equal", """
WITH l AS (
  SELECT CASE WHEN l_orderkey % 3 = 0 THEN 1000 ELSE l_orderkey * 10 + l_linenumber END AS key,
    CASE WHEN l_orderkey % 3 = 0 THEN 40 ELSE 20 + l_linenumber END + 1 AS b FROM lineitem
), w AS (SELECT *, coalesce(sum(b) OVER (ORDER BY key, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pre
         FROM l WHERE key <> 1000 OR b = 41)
SELECT CAST(0 AS INTEGER) AS chunk, CAST(pre // 50000 AS INTEGER) AS part, CAST(count(*) AS BIGINT) AS rows,
       CAST(sum(b) AS BIGINT) AS bytes, min(key) AS min_key, max(key) AS max_key
FROM w GROUP BY 1, 2""")
def q_part_assign_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2/A5 — a third of the rows are one line of one key: cut at the limit like others, rows numbered
    only where a part begins among them."""
    hot = F.col("l_orderkey") % 3 == 0
    rows = read_table(spark, sf_dir, "lineitem").select(
        F.when(hot, 1000).otherwise(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("key"),
        F.when(hot, F.repeat(F.lit("x"), 40)).otherwise(
            F.rpad((F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string"), 20 + F.col("l_linenumber"), "-")).alias("line"),
        F.lit(0).alias("chunk"))
    return export.part_report(export.assign_parts(rows, "key", "line", 50_000, bucket_bytes=256 << 10), "key")


# --------------------------------------------------------------------------
# W1/W3/A5 — chunked, size-bounded gzip parts written and read back

@register("part_report", with_src(
    f"SELECT doc_id AS key, {DOC_LINE_SQL} AS b FROM documents", sp_count(4), assigned(), """,
w AS (SELECT *, coalesce(sum(b) OVER (PARTITION BY chunk ORDER BY key
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pre FROM asg)
SELECT chunk, CAST(pre // 1048576 AS INTEGER) AS part, CAST(count(*) AS BIGINT) AS rows,
       CAST(sum(b) AS BIGINT) AS bytes, min(key) AS min_key, max(key) AS max_key
FROM w GROUP BY 1, 2"""))
def q_part_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    ranges = splits.split_count(docs, "doc_id", 4, small_rows=splits.SMALL_TABLE_ROWS)
    rows = splits.with_chunk(docs, ranges).select(
        "doc_id", "chunk",
        F.to_json(F.struct("doc_id", "text", "lang", "source", "n_chars")).alias("line"))
    parted = export.assign_parts(rows, "doc_id", "line", 1 << 20)
    path = export.write_parts(parted, scratch_path(spark, "parts") + "/documents", "doc_id")
    back = spark.read.text(path)
    return (back.groupBy("chunk", "part")
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.sum(export.line_bytes("value")).alias("bytes"),
                 F.min(F.get_json_object("value", "$.doc_id").cast("bigint")).alias("min_key"),
                 F.max(F.get_json_object("value", "$.doc_id").cast("bigint")).alias("max_key")))


# --------------------------------------------------------------------------
# S5/W1 — cleaned documents through gzip JSON lines and back, typed


@register("jsonl_roundtrip", with_src(
    f"SELECT {HEX} AS key, epoch_us(ts) // 1000000 AS sec, * FROM ({EVENTS_OK})",
    sp_time(4), assigned(), """
SELECT key AS id, user_id, value, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'n' || event_id END AS note,
       chunk
FROM asg WHERE outcome = 'ok'"""))
def q_jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events_with_key(spark, sf_dir, "_id")
    ranges = splits.split_time(ev, "_id", 4)
    raw = with_raw_doc(splits.with_chunk(ev, ranges), "_id", "chunk")
    cleaned = clean.clean_documents(spread(raw), string_fields=STRING_FIELDS)
    good, _ = clean.split_rejects(cleaned)
    parted = export.assign_parts(good, "_id", "line", 256 << 10)
    path = export.write_parts(parted, scratch_path(spark, "jsonl") + "/events", "_id")
    schema = conform.schema_from_spec([
        {"name": "id", "type": "STRING"}, {"name": "user_id", "type": "INTEGER"},
        {"name": "value", "type": "FLOAT"}, {"name": "note", "type": "STRING"}])
    back = export.read_lines(spark, path, schema)
    return back.select("id", "user_id", "value", "note", F.col("chunk").cast("int").alias("chunk"))



@register("sort_full", """
SELECT o_orderkey, row_number() OVER (ORDER BY CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_orderkey END, o_orderkey) - 1 AS place
FROM orders""")
def q_sort_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 — a total order over files; a third of the rows have one first key."""
    rows = read_table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 3 == 0, 7).otherwise(F.col("o_orderkey")).alias("k"), "o_orderkey")
    path = scratch_path(spark, "sorted")
    files = export.write_sorted(rows, path, ["k", "o_orderkey"], partitions=16)
    back = spark.read.parquet(path).select("o_orderkey", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("i"))
    return back.join(files.select("file", "before"), "file").select("o_orderkey", (F.col("before") + F.col("i")).alias("place"))


@register("export_both_ways", """
SELECT CAST(count(*) AS BIGINT) AS lines, CAST(count(*) AS BIGINT) AS equal, true AS has_unnamed FROM orders""")
def q_export_both_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 — the typed path and the document path export the same documents, with columns that the
    table's schema doesn't name."""
    orders = read_table(spark, sf_dir, "orders")
    named = [f for f in load.typed_schema_spec(orders.schema) if f["name"] in ("o_orderkey", "o_custkey", "o_orderstatus")]
    lines = []
    for fast in (True, False):
        root = scratch_path(spark, "both")
        r = load.load_table(spark, orders, events_spec(named, "orders.json"), fresh_warehouse(spark, f"both-{fast}".lower()),
                            load.LoadOptions(key="o_orderkey", chunks=3, method="count", export_root=root, typed_fast_path=fast))
        lines.append(spark.read.text(r.export_path + "/parts").select(F.get_json_object("value", "$.o_orderkey").alias("key"), "value"))
    a, b = lines
    # whole documents are parsed behind the join: a gzip file of up to a part's limit is read by one task
    doc = lambda c: F.parse_json(c).cast("string")
    both = (a.join(b.withColumnRenamed("value", "other"), "key", "full")
            .select(doc("value").alias("doc"), doc("other").alias("other")))
    return both.agg(F.count("doc").alias("lines"), F.count(F.when(F.col("doc") == F.col("other"), 1)).alias("equal"),
                    F.every(F.get_json_object("doc", "$.o_totalprice").isNotNull()).alias("has_unnamed"))


# --------------------------------------------------------------------------
# W4–W12, A6 — publish into a run-private warehouse, return what was published

EVENTS_SPEC = [
    {"name": "id", "type": "STRING", "mode": "REQUIRED"},
    {"name": "event_type", "type": "STRING"},
    {"name": "user_id", "type": "INTEGER"},
    {"name": "value", "type": "FLOAT"},
    {"name": "note", "type": "STRING"},
    {"name": "tags", "type": "STRING", "mode": "REPEATED"},
    {"name": "meta", "type": "STRING"},
]


def fresh_warehouse(spark: SparkSession, tag: str) -> publish.Warehouse:
    root = scratch_path(spark, f"warehouse-{tag}")
    suffix = uuid.uuid4().hex[:10]
    return publish.Warehouse(root, f"final_{suffix}", f"staging_{suffix}").ensure(spark)


def event_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events_with_key(spark, sf_dir, "_id").select("_id", "event_id", "ts", "user_id",
                                                      "event_type", "value", "props")
    return with_raw_doc(ev, "_id")


def events_spec(spec: list[dict] | None = None, name: str = "events_docs.json") -> TableSpec:
    import json
    return spec_from_text(name, json.dumps(spec or EVENTS_SPEC))


META_SQL = """CASE WHEN event_id % 4 = 0 THEN '{"_id":' || event_id || ',"src":"' || event_type || '"}'
                  ELSE 'plain' END"""
NOTE_SQL = "CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'n' || event_id END"
LOADED = f"({EVENTS_OK}) WHERE outcome = 'ok' AND event_id % 5 NOT IN (2, 3)"


@register("publish_create", f"""
SELECT {HEX} AS id, user_id, value, {NOTE_SQL} AS note,
       CAST(CASE WHEN event_id % 5 = 4 THEN 1 ELSE 0 END AS INTEGER) AS n_tags, {META_SQL} AS meta
FROM {LOADED}""")
def q_publish_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W6 — final table created from the schema and loaded directly (no staging)."""
    wh = fresh_warehouse(spark, "create")
    spec = events_spec()
    load.load_table(spark, event_docs(spark, sf_dir), spec, wh,
                    load.LoadOptions(on_bad="reject", reject_root=scratch_path(spark, "rejects"), key="_id", chunks=4, method="count", use_staging=False))
    t = spark.table(wh.name(spec.table))
    return t.select("id", "user_id", "value", "note", F.size("tags").alias("n_tags"), "meta")


@register("publish_json", f"""
SELECT {HEX} AS id, user_id, value, {NOTE_SQL} AS note,
       CAST(CASE WHEN event_id % 5 = 4 THEN 1 ELSE 0 END AS INTEGER) AS n_tags, {META_SQL} AS meta, 'json' AS sink
FROM {LOADED}""")
def q_publish_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9 — the same load into a table of JSON lines, over a parquet table that was there before."""
    wh = fresh_warehouse(spark, "json")
    spec = events_spec()
    for sink in ("parquet", "json"):
        load.load_table(spark, event_docs(spark, sf_dir), spec, wh, load.LoadOptions(
            on_bad="reject", reject_root=scratch_path(spark, "rejects"), key="_id", chunks=4, method="count", sink=sink,
            overwrite=True))
    t = spark.table(wh.name(spec.table))
    return t.select("id", "user_id", "value", "note", F.size("tags").alias("n_tags"), "meta",
                    F.lit(publish.sink_of(spark, wh.name(spec.table))).alias("sink"))


OK_DOCS = f"({EVENTS_OK}) WHERE outcome = 'ok'"


@register("publish_skip", f"""
SELECT 1 AS run, 'ok' AS status, CAST(count(*) AS BIGINT) AS rows FROM {OK_DOCS}
UNION ALL SELECT 2, 'skipped', NULL""")
def q_publish_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4/W5 — a second run without overwrite finds the final table and skips."""
    wh = fresh_warehouse(spark, "skip")
    spec = events_spec([{"name": "id", "type": "STRING"}, {"name": "user_id", "type": "INTEGER"}])
    opts = load.LoadOptions(on_bad="reject", reject_root=scratch_path(spark, "rejects"), key="_id", chunks=4, method="time")
    runs = [load.load_table(spark, event_docs(spark, sf_dir), spec, wh, opts) for _ in range(2)]
    return spark.createDataFrame([(i + 1, r.status, r.rows) for i, r in enumerate(runs)],
                                 "run int, status string, rows bigint")


@register("publish_overwrite", f"""
SELECT {HEX} AS id, value, event_type FROM {OK_DOCS}""")
def q_publish_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W7/W8 — overwrite drops and re-creates: the new schema takes effect."""
    wh = fresh_warehouse(spark, "overwrite")
    first = events_spec([{"name": "id", "type": "STRING"}, {"name": "user_id", "type": "INTEGER"}])
    second = events_spec([{"name": "id", "type": "STRING"}, {"name": "value", "type": "FLOAT"},
                          {"name": "event_type", "type": "STRING"}])
    load.load_table(spark, event_docs(spark, sf_dir), first, wh,
                    load.LoadOptions(on_bad="reject", reject_root=scratch_path(spark, "rejects"), key="_id", chunks=3, method="sampling"))
    load.load_table(spark, event_docs(spark, sf_dir), second, wh,
                    load.LoadOptions(on_bad="reject", reject_root=scratch_path(spark, "rejects"), key="_id", chunks=3, method="sampling", overwrite=True))
    return spark.table(wh.name(second.table))


@register("publish_staged", f"""
SELECT {HEX} AS id, user_id, {NOTE_SQL} AS note, true AS in_staging FROM {OK_DOCS}""")
def q_publish_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W9–W12 — load into staging (with a gzip export), publish by truncate-copy."""
    wh = fresh_warehouse(spark, "staged")
    spec = events_spec([{"name": "id", "type": "STRING"}, {"name": "user_id", "type": "INTEGER"},
                        {"name": "note", "type": "STRING"}])
    export_root = scratch_path(spark, "stage-files")
    load.load_table(spark, event_docs(spark, sf_dir), spec, wh,
                    load.LoadOptions(on_bad="reject", reject_root=scratch_path(spark, "rejects"), key="_id", chunks=4, method="time", use_staging=True,
                                     export_root=export_root, part_limit=128 << 10,
                                     keep_export=False))
    final = spark.table(wh.name(spec.table))
    staging = spark.table(wh.name(spec.table, staging=True)).select("id").withColumn(
        "in_staging", F.lit(True))
    return final.join(staging, "id", "left").select(
        "id", "user_id", "note", F.coalesce("in_staging", F.lit(False)).alias("in_staging"))


@register("load_report", f"""
SELECT 'events_docs' AS table_name, 'ok' AS status,
       CAST(sum(CASE WHEN outcome = 'ok' AND event_id % 5 NOT IN (2, 3) THEN 1 ELSE 0 END) AS BIGINT) AS rows,
       CAST(sum(CASE WHEN outcome <> 'ok' OR event_id % 5 IN (2, 3) THEN 1 ELSE 0 END) AS BIGINT) AS rejects,
       CAST(CASE WHEN count(*) >= 1000 THEN 4 ELSE 1 END AS BIGINT) AS chunks
FROM ({EVENTS_OK})""")
def q_load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6/C8 — rows loaded (observed on the write) and rejects of one run."""
    wh = fresh_warehouse(spark, "report")
    r = load.load_table(spark, event_docs(spark, sf_dir), events_spec(), wh,
                        load.LoadOptions(on_bad="reject", reject_root=scratch_path(spark, "rejects"), key="_id", chunks=4, method="count",
                                         export_root=scratch_path(spark, "report-files")))
    return spark.createDataFrame([(r.table, r.status, r.rows, r.rejects, r.chunks)],
                                 "table_name string, status string, rows bigint, "
                                 "rejects bigint, chunks bigint")


@register("load_rejects", f"""
SELECT {HEX} AS key, CASE WHEN outcome = 'ok' THEN 'bad value' ELSE outcome END AS reject_reason, true AS whole
FROM ({EVENTS_OK}) WHERE outcome <> 'ok' OR event_id % 3 <> 0""")
def q_load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C8 — what a load without export rejects is kept: key, reason and content."""
    spec = events_spec([{"name": "id", "type": "STRING"}, {"name": "note", "type": "INTEGER"}])
    r = load.load_table(spark, event_docs(spark, sf_dir), spec, fresh_warehouse(spark, "rejects"),
                        load.LoadOptions(on_bad="reject", reject_root=scratch_path(spark, "rejects"),
                                         key="_id", chunks=4, method="count"))
    kept = spark.read.schema("key string, chunk int, doc string, reject_reason string").json(r.reject_path)
    whole = F.col("doc").contains(F.concat(F.lit('id":"'), F.col("key"))) & F.col("doc").contains('"items":[')
    return kept.select("key", "reject_reason", whole.alias("whole"))


@register("load_from_ranges", with_src(
    f"SELECT {HEX} AS key, * FROM ({EVENTS_OK})", sp_count(7, 0), assigned(), """
SELECT chunk, CAST(count(*) AS BIGINT) AS rows, min(key) AS min_key, max(key) AS max_key
FROM asg WHERE outcome = 'ok' GROUP BY chunk"""))
def q_load_from_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R5 — a load takes the table's file from its range folder: 7 chunks, though 3 are asked for."""
    docs = event_docs(spark, sf_dir)
    spec = events_spec([{"name": "id", "type": "STRING"}, {"name": "user_id", "type": "INTEGER"}])
    folder = scratch_path(spark, "range-folder")
    range_files.make_range_file(spark, docs, "_id", f"{folder}/{spec.source}.json", chunks=7, method=3)
    r = load.load_table(spark, docs, spec, fresh_warehouse(spark, "ranges"), load.LoadOptions(
        on_bad="reject", key="_id", chunks=3, range_folder=folder, export_root=scratch_path(spark, "range-files")))
    key = F.get_json_object("value", "$.id")
    return (spark.read.text(r.export_path + "/parts").groupBy("chunk")
            .agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("min_key"), F.max(key).alias("max_key")))


# --------------------------------------------------------------------------
# B1/B2/A7 — every test table in one batch; one fails, one is skipped

BATCH_FAIL = "labels"  # its spec declares quality BOOLEAN; the 0/1 values do not load
BATCH_SKIP = "benchmark"  # its final table exists before the run


def write_batch_specs(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """One ``<table>.json`` schema file per test table, written through Spark."""
    import json
    rows = []
    for name in TABLES:
        spec_list = load.typed_schema_spec(read_table(spark, sf_dir, name).schema)
        if name == BATCH_FAIL:
            for f in spec_list:
                if f["name"] == "quality":
                    f["type"] = "BOOLEAN"
        rows.append((name, json.dumps(spec_list, indent=2)))
    # partitionBy gives one folder per table; each holds one text file that
    # is then exposed under the plain ``<table>.json`` name by a rename.
    spark.createDataFrame(rows, "t string, value string").repartition(1).write.mode(
        "overwrite").partitionBy("t").text(folder + "/_by_table")
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    base = jvm.org.apache.hadoop.fs.Path(folder)
    fs = base.getFileSystem(conf)
    for name in TABLES:
        src_dir = jvm.org.apache.hadoop.fs.Path(f"{folder}/_by_table/t={name}")
        part = [st.getPath() for st in fs.listStatus(src_dir)
                if st.getPath().getName().startswith("part-")][0]
        fs.rename(part, jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.json"))
    fs.delete(jvm.org.apache.hadoop.fs.Path(folder + "/_by_table"), True)
    return folder


def batch_jobs(spark: SparkSession, sf_dir: str) -> list[batch.TableJob]:
    """S8 — discover the schema files of a folder, one load job per file."""
    folder = write_batch_specs(spark, sf_dir, scratch_path(spark, "specs"))
    jobs = []
    for spec in discover_specs(spark, folder):
        name = spec.source
        key = read_table(spark, sf_dir, name).columns[0]
        jobs.append(batch.TableJob(
            spec, lambda s, n=name: read_table(s, sf_dir, n),
            load.LoadOptions(key=key, chunks=10, method="count", on_bad="fail",
                             rename_id=False)))
    return jobs


@register("batch_summary", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, "
    + ("'failed' AS status, CAST(NULL AS BIGINT) AS rows" if t == BATCH_FAIL else
       "'skipped' AS status, CAST(NULL AS BIGINT) AS rows" if t == BATCH_SKIP else
       "'ok' AS status, CAST(max(n) AS BIGINT) AS rows")
    + f" FROM (SELECT count(*) AS n FROM {t})" for t in TABLES))
def q_batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_all(spark, sf_dir).report(spark).select("table_name", "status", "rows")


@register("batch_totals", f"""
SELECT CAST({len(TABLES)} AS BIGINT) AS total, CAST({len(TABLES) - 2} AS BIGINT) AS ok,
       CAST(1 AS BIGINT) AS skipped, CAST(1 AS BIGINT) AS failed""")
def q_batch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 — tables of a batch by how they ended."""
    return _run_all(spark, sf_dir).summary(spark)


def _run_all(spark: SparkSession, sf_dir: str) -> batch.BatchResult:
    wh = fresh_warehouse(spark, "batch")
    jobs = batch_jobs(spark, sf_dir)
    skip = next(j for j in jobs if j.spec.table == BATCH_SKIP)
    publish.create_table(spark, wh.name(skip.spec.table), skip.spec.schema)
    return batch.run_batch(spark, jobs, wh, workers=3)


# --------------------------------------------------------------------------
# W13/W14 — table names from paths (every page URL treated as a schema path)


@register("normalize_names", """
WITH b AS (SELECT page_id, regexp_extract(regexp_replace(url, '/+$', ''), '([^/]*)$', 1) AS base FROM pages),
s AS (SELECT page_id, regexp_replace(base, '\\.[^.]*$', '') AS stem FROM b),
n AS (SELECT page_id, stem, lower(regexp_replace(stem, '[^a-zA-Z0-9_]+', '_', 'g')) AS norm FROM s)
SELECT page_id, stem AS source_name,
       CASE WHEN norm = '' THEN '' WHEN regexp_matches(norm, '^[a-zA-Z_]') THEN norm
            ELSE 't_' || norm END AS table_name
FROM n""")
def q_normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return pages.select("page_id", source_name_col("url").alias("source_name"),
                        normalize_table_name_col("url").alias("table_name"))
