"""Checked queries for document cleaning.

Raw documents are made from every ``events`` row by string concatenation:
each holds an object-id ``_id``, typed fields, a JSON ``props`` record, and
injected cases — null fields, ``[null]`` / ``[]`` / ``[null,null]`` arrays,
nested ``_id`` keys, a record in a field the schema types as STRING — plus
broken documents (truncated, duplicate key, ``_id`` next to ``id``, NaN).
The oracle derives the expected cleaned values straight from the columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanload.operators import clean
from spanload.plans.registry import register
from spanload.session import spread
from spanload.sources.tables import events_with_key, read_table

# The schema of the document table says these fields are STRING.
STRING_FIELDS = ("event_type", "meta", "note")

_KIND = """CASE WHEN event_id % 97 = 0 THEN 'trunc' WHEN event_id % 89 = 0 THEN 'dupid'
     WHEN event_id % 83 = 0 THEN 'nan' WHEN event_id % 79 = 0 THEN 'dupkey' ELSE 'ok' END"""

_BODY = """'"_id":"' || _id || '","event_type":"' || event_type || '","user_id":' || CAST(user_id AS STRING)
 || ',"value":' || CAST(value AS STRING) || ',"props":' || props
 || ',"note":' || CASE WHEN event_id % 3 = 0 THEN 'null' ELSE '"n' || CAST(event_id AS STRING) || '"' END
 || ',"tags":' || CASE event_id % 5 WHEN 0 THEN '[null]' WHEN 1 THEN '[]' WHEN 2 THEN '[null,null]'
                  WHEN 3 THEN '[null,1]' ELSE '["' || event_type || '"]' END
 || ',"items":[{"_id":' || CAST(user_id AS STRING) || ',"q":null}]'
 || ',"meta":' || CASE WHEN event_id % 4 = 0
                  THEN '{"src":"' || event_type || '","_id":' || CAST(event_id AS STRING) || '}'
                  ELSE '"plain"' END"""

_DOC = """CASE _kind
  WHEN 'trunc' THEN '{' || _body
  WHEN 'dupid' THEN '{' || _body || ',"id":"x"}'
  WHEN 'nan' THEN '{' || _body || ',"score":NaN}'
  WHEN 'dupkey' THEN '{' || _body || ',"user_id":0}'
  ELSE '{' || _body || '}' END"""


def with_raw_doc(ev: DataFrame, *keep: str) -> DataFrame:
    """One raw JSON document per events row (the body is built once per row)."""
    staged = ev.withColumn("_body", F.expr(_BODY)).withColumn("_kind", F.expr(_KIND))
    return staged.select(*keep, F.expr(_DOC).alias("doc"))


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 input: one raw JSON document per events row, with its event_id."""
    ev = spread(events_with_key(spark, sf_dir, "_id"))
    return with_raw_doc(ev, "event_id")


def cleaned_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned lines and reject reasons of all raw documents."""
    return clean.clean_documents(raw_documents(spark, sf_dir), "doc", string_fields=STRING_FIELDS)


def _outcome() -> F.Column:
    return F.coalesce(F.col("reject_reason"), F.lit("ok")).alias("outcome")


# Oracle side ---------------------------------------------------------------

OUTCOME = f"""(CASE {_KIND} WHEN 'trunc' THEN 'undecodable' WHEN 'dupid' THEN 'duplicate id'
   WHEN 'nan' THEN 'non-finite number' WHEN 'dupkey' THEN 'duplicate key' ELSE 'ok' END)"""

HEX_KEY = "(format('{:08x}', epoch_us(ts) // 1000000) || format('{:016x}', event_id))"


@register("clean_nulls", f"""
SELECT event_id, {OUTCOME} AS outcome,
       CASE WHEN {OUTCOME} = 'ok' THEN concat_ws(',', 'event_type', 'id', 'items', 'meta',
            CASE WHEN event_id % 3 <> 0 THEN 'note' END, 'props',
            CASE WHEN event_id % 5 <> 0 THEN 'tags' END, 'user_id', 'value') END AS keys
FROM events""")
def q_clean_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 — null fields are gone (top level); key list per document."""
    c = cleaned_documents(spark, sf_dir)
    return c.select("event_id", _outcome(),
                    F.array_join(F.sort_array(F.json_object_keys("line")), ",").alias("keys"))


@register("clean_null_arrays", f"""
SELECT event_id, {OUTCOME} AS outcome,
       CASE WHEN {OUTCOME} = 'ok' THEN CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '[]'
            WHEN 2 THEN '[null,null]' WHEN 3 THEN '[null,1]'
            ELSE '["' || event_type || '"]' END END AS tags
FROM events""")
def q_clean_null_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2/F6 — ``[null]`` arrays dropped, other arrays kept as they were."""
    c = cleaned_documents(spark, sf_dir)
    return c.select("event_id", _outcome(), F.get_json_object("line", "$.tags").alias("tags"))


@register("clean_record_to_string", f"""
SELECT event_id, {OUTCOME} AS outcome,
       CASE WHEN {OUTCOME} = 'ok' THEN CASE WHEN event_id % 4 = 0
            THEN '{{"_id":' || event_id || ',"src":"' || event_type || '"}}' ELSE 'plain' END END AS meta,
       CASE WHEN {OUTCOME} = 'ok' THEN event_type END AS event_type
FROM events""")
def q_clean_record_to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3 — a record in a STRING field becomes its JSON text (``_id`` kept inside)."""
    c = cleaned_documents(spark, sf_dir)
    return c.select("event_id", _outcome(),
                    F.get_json_object("line", "$.meta").alias("meta"),
                    F.get_json_object("line", "$.event_type").alias("event_type"))


@register("clean_rename_id", f"""
SELECT event_id, {OUTCOME} AS outcome,
       CASE WHEN {OUTCOME} = 'ok' THEN {HEX_KEY} END AS id,
       CASE WHEN {OUTCOME} = 'ok' THEN user_id END AS item_id,
       CASE WHEN {OUTCOME} = 'ok' THEN false END AS has_underscore_id
FROM events""")
def q_clean_rename_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5 — ``_id`` renamed to ``id`` at every depth of the encoded line."""
    c = cleaned_documents(spark, sf_dir)
    return c.select("event_id", _outcome(),
                    F.get_json_object("line", "$.id").alias("id"),
                    F.get_json_object("line", "$.items[0].id").cast("bigint").alias("item_id"),
                    F.col("line").contains('"_id":').alias("has_underscore_id"))


@register("jsonl_encode", f"""
SELECT event_id, {OUTCOME} AS outcome,
       CASE WHEN {OUTCOME} = 'ok' THEN user_id END AS user_id,
       CASE WHEN {OUTCOME} = 'ok' THEN value END AS value,
       CASE WHEN {OUTCOME} = 'ok' THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS props_k,
       CASE WHEN {OUTCOME} = 'ok' THEN false END AS multi_line
FROM events""")
def q_jsonl_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4 — one compact JSON line per good document; values survive."""
    c = cleaned_documents(spark, sf_dir)
    return c.select("event_id", _outcome(),
                    F.get_json_object("line", "$.user_id").cast("bigint").alias("user_id"),
                    F.get_json_object("line", "$.value").cast("double").alias("value"),
                    F.get_json_object("line", "$.props.k").cast("bigint").alias("props_k"),
                    F.col("line").contains("\n").alias("multi_line"))


@register("reject_bad_docs", f"""
SELECT event_id, {OUTCOME} AS reject_reason FROM events WHERE {OUTCOME} <> 'ok'""")
def q_reject_bad_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4/C8 — documents that cannot be decoded or encoded, with the reason."""
    _, bad = clean.split_rejects(cleaned_documents(spark, sf_dir))
    return bad.select("event_id", "reject_reason")


@register("reject_report", f"""
SELECT {OUTCOME} AS outcome, CAST(count(*) AS BIGINT) AS docs FROM events GROUP BY 1""")
def q_reject_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C8 — documents per outcome."""
    return clean.reject_counts(cleaned_documents(spark, sf_dir))


@register("reject_nonfinite", """
SELECT event_id, 'non-finite number' AS reject_reason FROM events
WHERE event_id % 83 = 0 OR event_id % 89 = 0 OR event_id % 97 = 0""")
def q_reject_nonfinite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7 — typed rows holding NaN or ±Infinity never become documents."""
    ev = read_table(spark, sf_dir, "events").withColumn(
        "value", F.expr("""CASE WHEN event_id % 83 = 0 THEN double('NaN')
                                WHEN event_id % 89 = 0 THEN double('Infinity')
                                WHEN event_id % 97 = 0 THEN double('-Infinity')
                                ELSE value END"""))
    docs = clean.rows_to_documents(ev, keep=["event_id"])
    return docs.where(F.col("reject_reason").isNotNull()).select("event_id", "reject_reason")
