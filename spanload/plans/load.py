"""One table, end to end (the single-table run).

``source → split (tiny range table) → chunk column → clean + conform →
stage (parquet, once) → [size-bounded gzip JSON-lines export] → publish``.

Cleaning and conformance run on the way to one parquet stage in the shared
checkpoint folder.  The chunk guard, reject counts and output, part
assignment and the typed load all read that materialised copy (mostly only
narrow columns) instead of parsing documents again, and the lineage is cut
so a lost executor costs a re-read, not a re-parse.
"""

from __future__ import annotations

import logging
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from spanload.operators import clean, conform, export, publish, splits
from spanload.session import scratch_path, spread
from spanload.sources.ranges import read_ranges
from spanload.sources.specs import TableSpec

log = logging.getLogger(__name__)

GIB = 1 << 30


@dataclass
class LoadOptions:
    key: str = "_id"
    chunks: int = 10
    method: str | None = None  # None → time
    small_rows: int = splits.SMALL_TABLE_ROWS  # R7: a source with fewer rows is one chunk
    ranges: splits.KeyRanges | None = None  # R5: a saved range table wins
    range_folder: str | None = None  # R5: else the file <folder>/<source table>.json, where there is one
    overwrite: bool = False
    use_staging: bool = True
    sink: str = "parquet"  # S9: the type of the table's files, see publish.SINKS
    part_limit: int = GIB  # W2: raw bytes per part
    export_root: str | None = None  # None → no JSON-lines side output
    keep_export: bool = True
    on_bad: str = "fail"  # F4; "reject" needs a place for the rejects
    reject_root: str | None = None  # C8; else under export_root
    on_empty: str = "error"  # X3
    rename_id: bool = True  # C5
    typed_fast_path: bool = True  # typed sources with compatible types skip JSON


@dataclass
class LoadResult:
    table: str
    status: str  # ok | skipped | failed
    rows: int | None = None
    rejects: int | None = None
    chunks: int | None = None
    parts: int | None = None
    seconds: float = 0.0
    error: str | None = None
    export_path: str | None = None
    reject_path: str | None = None
    reject_reasons: dict = field(default_factory=dict)


def load_table(spark: SparkSession, source: DataFrame, spec: TableSpec,
               wh: publish.Warehouse, opts: LoadOptions | None = None) -> LoadResult:
    opts = opts or LoadOptions()
    if opts.on_bad == "reject" and not (opts.reject_root or opts.export_root):
        raise ValueError("on_bad='reject' needs reject_root or export_root to keep the rejects in")
    publish.check_sink(opts.sink)
    t0 = time.time()
    res = LoadResult(spec.table, "ok")
    final = wh.name(spec.table)
    # W5 — checked before any read.
    publish.finish_pending(spark, final)
    if publish.table_exists(spark, final) and not opts.overwrite:
        res.status = "skipped"
        res.seconds = time.time() - t0
        return res
    key = opts.key
    saved = opts.ranges or saved_ranges(spark, source, spec, opts)
    ranges = splits.split(source, key, opts.chunks, opts.method, ranges=saved,
                          small_rows=opts.small_rows)
    res.chunks = ranges.n_chunks
    typed_mode = (opts.typed_fast_path and "doc" not in source.columns
                  and conform.typed_compatible(source.schema, spec.schema, opts.rename_id))
    rows = splits.with_chunk(spread(source), ranges, name="_chunk").withColumn(
        "_key", F.col(key))
    # Materialise the cleaned rows once, as parquet in the shared checkpoint
    # folder: later passes read only the columns they need (chunk, bytes,
    # key ...) and a lost executor costs a re-read, not a re-parse.
    stage_path = scratch_path(spark, f"stage-{spec.table}")
    stage = _stage_typed(rows, spec, opts) if typed_mode else _stage_documents(rows, spec, opts)
    try:
        stage.write.mode("overwrite").parquet(stage_path)
        staged = spark.read.parquet(stage_path)
        return _load_staged(spark, staged, spec, wh, opts, ranges, res, t0)
    finally:
        publish.delete_path(spark, stage_path)


def saved_ranges(spark: SparkSession, source: DataFrame, spec: TableSpec,
                 opts: LoadOptions) -> splits.KeyRanges | None:
    """R5 — the table's file in ``range_folder``, or None; a file that is no valid range table raises."""
    if not opts.range_folder:
        return None
    path = f"{opts.range_folder.rstrip('/')}/{spec.source}.json"
    if not publish.path_exists(spark, path):
        log.info("table %s has no range file %s", spec.table, path)
        return None
    found = read_ranges(spark, path, key=opts.key, require_hex=opts.method in (None, "time"))
    own = source.schema[opts.key].dataType
    if isinstance(found.dtype, StringType) != isinstance(own, StringType):
        raise ValueError(f"range file {path} holds {found.dtype.simpleString()} keys, "
                         f"{opts.key!r} is {own.simpleString()}")
    return found


# Every stage, whichever path made it, holds these columns plus the schema's.
STAGE_COLS = ["_key", "_chunk", "_reason", "_schema_bad", "_line", "_bytes", "_line_hash",
              "_doc"]


def _with_line_stats(df: DataFrame) -> DataFrame:
    return (df.withColumn("_bytes", F.coalesce(export.line_bytes("_line"), F.lit(0)))
            .withColumn("_line_hash", export.row_hash("_line")))


def _stage_documents(rows: DataFrame, spec: TableSpec, opts: LoadOptions) -> DataFrame:
    """Document path: raw JSON → cleaned line (C1–C8) → typed columns.

    Conformance runs here, on the way to the stage, so the typed columns and
    every reject (cleaning or schema) are materialised in the same pass and
    the publish never parses JSON again.
    """
    if "doc" in rows.columns:
        docs = rows.select("_key", "_chunk", F.col("doc").alias("_raw"))
    else:  # typed rows whose types need the JSON load rules
        src_cols = [c for c in rows.columns if c not in ("_key", "_chunk")]
        # a row that can't become a document is kept as Spark writes it
        rows = rows.withColumn("_row", F.to_json(F.struct(*[F.col(f"`{c}`") for c in src_cols])))
        docs = clean.rows_to_documents(rows, doc="_raw", keep=["_key", "_chunk", "_row"],
                                       cols=src_cols, reason="_pre")
    cleaned = clean.clean_documents(docs, "_raw", conform.string_fields(spec.schema),
                                    rename_id=opts.rename_id, line="_ln", reason="_cr0")
    cr = F.coalesce(F.col("_pre"), F.col("_cr0")) if "_pre" in docs.columns else F.col("_cr0")
    cleaned = cleaned.withColumn("_cr", cr)
    # Always staged in "reject" mode: a filter here would be pushed down into
    # the parsing projections and run them twice.  ``on_bad="fail"`` is
    # enforced on the stage (``_schema_bad``) before anything is published.
    typed = conform.conform_lines(cleaned, spec.schema, line="_ln", on_bad="reject",
                                  reason="_sr", keep=["_key", "_chunk", "_raw", "_ln", "_cr"]
                                  + [c for c in ("_row",) if c in cleaned.columns])
    raw = F.coalesce("_raw", "_row") if "_row" in cleaned.columns else F.col("_raw")
    # lines are staged only when they are exported (rejects keep theirs in _doc)
    line = F.col("_ln") if opts.export_root else F.lit(None).cast("string")
    out = typed.select(
        "_key", "_chunk", F.coalesce("_cr", "_sr").alias("_reason"),
        (F.col("_cr").isNull() & F.col("_sr").isNotNull()).alias("_schema_bad"),
        line.alias("_line"),
        F.when(F.col("_cr").isNotNull(), raw)
        .when(F.col("_sr").isNotNull(), F.col("_ln")).alias("_doc"),
        *[F.col(f.name) for f in spec.schema.fields])
    return _with_line_stats(out)


def _stage_typed(rows: DataFrame, spec: TableSpec, opts: LoadOptions) -> DataFrame:
    """Typed path: compatible columns conformed directly (no JSON round trip)."""
    src_cols = [c for c in rows.columns if c not in ("_key", "_chunk")]
    packed = rows.withColumn("_src", F.struct(*[F.col(f"`{c}`") for c in src_cols]))
    typed = conform.conform_typed(packed, spec.schema, on_bad="reject", reason="_reason",
                                  keep=["_key", "_chunk", "_src"], rename_id=opts.rename_id)
    is_bad = F.col("_reason").isNotNull()
    line = F.lit(None).cast("string")
    if opts.export_root:  # W1 — the line is the cleaned source row, as on the document path
        text = F.to_json("_src", {"ignoreNullFields": "false"})
        typed = clean.clean_documents(typed.withColumn("_raw", F.when(~is_bad, text)), "_raw",
                                      conform.string_fields(spec.schema), rename_id=opts.rename_id, line="_ln", reason="_cr")
        line = F.when(~is_bad, F.col("_ln"))
    out = typed.select(
        "_key", "_chunk", "_reason",
        (is_bad & (F.col("_reason") != F.lit(clean.NON_FINITE))).alias("_schema_bad"),
        line.alias("_line"),
        F.when(is_bad, F.to_json("_src")).alias("_doc"),  # a reject keeps its source row
        *[F.col(f.name) for f in spec.schema.fields])
    return _with_line_stats(out)


def _load_staged(spark: SparkSession, staged: DataFrame, spec: TableSpec,
                 wh: publish.Warehouse, opts: LoadOptions, ranges: splits.KeyRanges,
                 res: LoadResult, t0: float) -> LoadResult:
    is_bad = F.col("_reason").isNotNull()
    exported = F.col("_line").isNotNull()
    # X3 — empty chunks, C8 reject counts and export totals: one narrow pass.
    per_chunk = (staged.groupBy("_chunk").agg(
        F.count(F.lit(1)).alias("docs"),
        F.sum(F.when(is_bad, 1).otherwise(0)).alias("rejects"),
        F.sum(F.when(exported, 1).otherwise(0)).alias("lines"),
        F.sum(F.when(exported, F.col("_bytes")).otherwise(0)).alias("line_bytes"),
        F.sum(F.when(F.col("_schema_bad"), 1).otherwise(0)).alias("schema_bad"),
        F.min(F.when(F.col("_schema_bad"), F.col("_reason"))).alias("first_bad"))
        .collect())
    if opts.on_bad == "fail" and any(r["schema_bad"] for r in per_chunk):  # F4
        first = min(r["first_bad"] for r in per_chunk if r["first_bad"])
        n_bad = sum(r["schema_bad"] for r in per_chunk)
        raise RuntimeError(f"load failed: {n_bad} rows do not fit the schema ({first})")
    seen = {r["_chunk"] for r in per_chunk}
    empty = [c for c in range(ranges.n_chunks) if c not in seen]
    if empty and opts.on_empty == "error":
        raise RuntimeError(f"table {spec.table}: empty ranges {empty}")
    if opts.export_root:
        stamp = f"{publish.run_stamp()}-{uuid.uuid4().hex[:8]}"
        path = publish.staged_folder(opts.export_root, spec.table, stamp)
        n_lines = sum(r["lines"] for r in per_chunk)
        n_bytes = sum(r["line_bytes"] or 0 for r in per_chunk)
        sizes = {r["_chunk"]: r["line_bytes"] for r in per_chunk}
        lines = staged.where(exported).select(
            "_key", F.col("_chunk").alias("chunk"), F.col("_line").alias("line"),
            F.col("_bytes").alias("bytes"), F.col("_line_hash").alias("line_hash"))
        parted = export.assign_parts(lines, "_key", "line", opts.part_limit,
                                     n_rows=n_lines, total_bytes=n_bytes)
        export.write_parts(parted, path + "/parts", "_key",
                           tasks=export.writing_tasks(staged, n_bytes, opts.part_limit, ranges.n_chunks),
                           chunk_parts=[(sizes.get(c) or 0) // opts.part_limit + 1 for c in range(ranges.n_chunks)])
        res.export_path = path
        res.parts = export.file_sizes(spark, path + "/parts").count()  # listing only
    n_rejects = sum(r["rejects"] for r in per_chunk)
    if n_rejects:  # C8 — rejected documents are kept, with their reason, before anything is published
        root = (f"{opts.reject_root.rstrip('/')}/{spec.table}-{publish.run_stamp()}-{uuid.uuid4().hex[:8]}"
                if opts.reject_root else res.export_path)
        if root is None:
            raise RuntimeError(f"load failed: {n_rejects} rejected documents and no reject_root to keep them in")
        res.reject_path = f"{root}/rejects"
        staged.where(is_bad).select(
            F.col("_key").alias("key"), F.col("_chunk").alias("chunk"),
            F.col("_doc").alias("doc"), F.col("_reason").alias("reject_reason")
        ).write.mode("overwrite").json(res.reject_path)
    # typed columns are already in the stage: the load parses nothing
    loadable = staged.where(~is_bad).select(*[F.col(f.name) for f in spec.schema.fields])
    out = publish.publish(spark, loadable, spec.schema, spec.table, wh,
                          overwrite=opts.overwrite, use_staging=opts.use_staging, sink=opts.sink)
    res.status = out["status"]
    res.rows = out["rows"]
    res.reject_reasons = {r[0]: r[1] for r in staged.where(is_bad)
                          .groupBy("_reason").count().collect()}
    res.rejects = sum(res.reject_reasons.values())
    if res.export_path and not opts.keep_export:
        publish.delete_path(spark, res.export_path + "/parts")  # W11
    res.seconds = time.time() - t0
    return res


def typed_schema_spec(schema: StructType) -> list[dict]:
    """A table-schema list describing a typed DataFrame (for loading test tables)."""
    from pyspark.sql.types import (ArrayType, BooleanType, DateType, DoubleType,
                                   FloatType, IntegerType, LongType, ShortType,
                                   StringType, TimestampNTZType, TimestampType)

    def one(name: str, dt) -> dict:
        if isinstance(dt, ArrayType):
            d = one(name, dt.elementType)
            d["mode"] = "REPEATED"
            return d
        if isinstance(dt, StructType):
            return {"name": name, "type": "RECORD",
                    "fields": [one(f.name, f.dataType) for f in dt.fields]}
        mapping = [((LongType, IntegerType, ShortType), "INTEGER"),
                   ((DoubleType, FloatType), "FLOAT"), ((StringType,), "STRING"),
                   ((BooleanType,), "BOOLEAN"), ((DateType,), "DATE"),
                   ((TimestampNTZType,), "DATETIME"), ((TimestampType,), "TIMESTAMP")]
        for types, tname in mapping:
            if isinstance(dt, types):
                return {"name": name, "type": tname}
        raise ValueError(f"no table type for {dt.simpleString()}")

    return [one(f.name, f.dataType) for f in schema.fields]
