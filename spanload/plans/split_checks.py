"""Checked queries for splitting, chunk assignment and chunk reports.

The Spark side calls the operators; the SQL side recomputes the same answer
with global ``row_number`` / min / max in plain SQL, which is fine for an
oracle at test scale and is exactly what the operators avoid at scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanload.functions.keys import epoch_micros, epoch_seconds, key_seconds
from spanload.operators import chunks, splits
from spanload.plans.registry import register
from spanload.sources import ranges as range_files
from spanload.sources.tables import events_with_key, orders_with_key, read_table
from spanload.session import scratch_path

# --------------------------------------------------------------------------
# SQL building blocks (oracle side)


def sql_hex_key(ts: str, seq: str) -> str:
    return f"(format('{{:08x}}', epoch_us({ts}) // 1000000) || format('{{:016x}}', {seq}))"


EVENTS_HEX = f"SELECT {sql_hex_key('ts', 'event_id')} AS key, epoch_us(ts) // 1000000 AS sec, * FROM events"
ORDERS_HEX = (f"SELECT {sql_hex_key('o_orderdate', 'o_orderkey')} AS key, "
              "epoch_us(o_orderdate) // 1000000 AS sec, * FROM orders")


def sp_count(n: int, gate: int = 1000) -> str:
    """Split points of an exact count split over CTE ``src(key)``."""
    return f"""
tot AS (SELECT count(*) AS total FROM src),
ord AS (SELECT key, row_number() OVER (ORDER BY key) AS rn FROM src),
sp AS (SELECT DISTINCT o.key FROM ord o, tot
       WHERE tot.total >= {gate}
         AND o.rn % greatest(1, tot.total // {n}) = 0
         AND o.rn // greatest(1, tot.total // {n}) BETWEEN 1 AND {n - 1})"""


def sp_time(n: int, gate: int = 1000) -> str:
    """Split points of a time split over CTE ``src(key, sec)``."""
    return f"""
bnd AS (SELECT count(*) AS total, min(sec) AS lo, max(sec) AS hi FROM src),
sp AS (SELECT DISTINCT format('{{:08x}}', lo + CAST(trunc(CAST((hi - lo) * 1000000000 AS DOUBLE)
                 * (CAST(i AS DOUBLE) / {n})) AS BIGINT) // 1000000000) || '0000000000000000' AS key
       FROM bnd, range(1, {n}) r(i)
       WHERE bnd.total >= {gate} AND bnd.hi > bnd.lo)"""


def sp_sample_all(n: int) -> str:
    """Split points of a sampling split when the sample is every row."""
    return f"""
dk AS (SELECT DISTINCT key FROM src),
dl AS (SELECT key, row_number() OVER (ORDER BY key) - 1 AS idx FROM dk),
dn AS (SELECT count(*) AS len, CASE WHEN count(*) < {n} + 1 THEN count(*) - 1 ELSE {n} END AS n2 FROM dk),
sp AS (SELECT DISTINCT dl.key FROM dl, dn, range(1, {n}) r(i)
       WHERE i < dn.n2 AND dl.idx = least((i * dn.len) // dn.n2, dn.len - 1))"""


def assigned() -> str:
    return """
asg AS (SELECT s.*, CAST((SELECT count(*) FROM sp WHERE sp.key <= s.key) AS INTEGER) AS chunk FROM src s)"""


def chunk_report_select() -> str:
    return """,
spn AS (SELECT key, CAST(row_number() OVER (ORDER BY key) AS INTEGER) AS i FROM sp),
ch AS (SELECT 0 AS chunk UNION ALL SELECT i FROM spn)
SELECT ch.chunk,
       (SELECT key FROM spn WHERE spn.i = ch.chunk) AS start_id,
       (SELECT key FROM spn WHERE spn.i = ch.chunk + 1) AS end_id,
       CAST((SELECT count(*) FROM asg WHERE asg.chunk = ch.chunk) AS BIGINT) AS rows
FROM ch"""


def per_chunk_select(extra: str = "") -> str:
    return f"""
SELECT chunk, CAST(count(*) AS BIGINT) AS rows, min(key) AS min_key, max(key) AS max_key{extra}
FROM asg GROUP BY chunk"""


def with_src(src: str, *parts: str) -> str:
    body = ",".join(p for p in parts[:-1])
    return f"WITH src AS ({src}),{body}\n{parts[-1]}"


# --------------------------------------------------------------------------
# Spark side helpers


def _per_chunk(df: DataFrame, ranges: splits.KeyRanges) -> DataFrame:
    k = ranges.key
    return (splits.with_chunk(df.select(k), ranges)
            .groupBy("chunk")
            .agg(F.count(F.lit(1)).alias("rows"), F.min(k).alias("min_key"),
                 F.max(k).alias("max_key")))


def _events_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").withColumnRenamed("event_id", "key")


EVENTS_ID = "SELECT event_id AS key, * FROM events"

# --------------------------------------------------------------------------
# S1 — full scan: one open range, every row and column read


@register("scan_full", """
SELECT CAST(0 AS INTEGER) AS chunk, event_id, epoch_us(ts) AS ts_us, user_id, event_type, value,
       props FROM events""")
def q_scan_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    single = splits.split(ev, "event_id", 1, "count")
    return chunks.chunk_scan(splits.with_chunk(ev, single), single, 0).select(
        "chunk", "event_id", epoch_micros("ts").alias("ts_us"),
        "user_id", "event_type", "value", "props")


# --------------------------------------------------------------------------
# R1 — exact split by count


@register("split_count", with_src(EVENTS_ID, sp_count(10), assigned(), per_chunk_select()))
def q_split_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _events_id(spark, sf_dir)
    return _per_chunk(df, splits.split_count(df, "key", 10))


@register("split_count_orders",
          with_src("SELECT o_orderkey AS key, * FROM orders", sp_count(4), assigned(),
                   per_chunk_select()))
def q_split_count_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read_table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "key")
    return _per_chunk(df, splits.split_count(df, "key", 4))


@register("split_count_ties",
          with_src("SELECT l_orderkey AS key, * FROM lineitem", sp_count(10), assigned(),
                   per_chunk_select()))
def q_split_count_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-unique keys: all ties of a split point go to the upper range."""
    df = read_table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "key")
    return _per_chunk(df, splits.split_count(df, "key", 10))


# --------------------------------------------------------------------------
# R2 — split by key creation time


@register("split_time", with_src(EVENTS_HEX, sp_time(4), assigned(), chunk_report_select()))
def q_split_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = events_with_key(spark, sf_dir, "key")
    return chunks.chunk_report(df, splits.split_time(df, "key", 4))


@register("split_time_orders",
          with_src(ORDERS_HEX, sp_time(10), assigned(), chunk_report_select()))
def q_split_time_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = orders_with_key(spark, sf_dir, "key")
    return chunks.chunk_report(df, splits.split_time(df, "key", 10))


FLAT_SRC = ("SELECT '65920087' || format('{:016x}', event_id) AS key, "
            "CAST(1704067207 AS BIGINT) AS sec, * FROM events")


@register("split_time_flat", with_src(FLAT_SRC, sp_time(10), assigned(), chunk_report_select()))
def q_split_time_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R11 — every key made in the same second: one open range."""
    df = read_table(spark, sf_dir, "events").withColumn(
        "key", F.concat(F.lit("65920087"), F.lpad(F.lower(F.hex("event_id")), 16, "0")))
    return chunks.chunk_report(df, splits.split_time(df, "key", 10))


# --------------------------------------------------------------------------
# R3/R4 — split by sampling (the sample is every row when rows <= 10,000)


@register("split_sample", with_src(EVENTS_ID, sp_sample_all(4), assigned(), per_chunk_select()))
def q_split_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _events_id(spark, sf_dir)
    return _per_chunk(df, splits.split_sample(df, "key", 4))


@register("split_sample_small",
          with_src("SELECT r_regionkey AS key, * FROM region", sp_sample_all(10), assigned(),
                   per_chunk_select()))
def q_split_sample_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read_table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "key")
    return _per_chunk(df, splits.split_sample(df, "key", 10))


@register("split_unknown_method",
          with_src(EVENTS_ID, sp_sample_all(5), assigned(), per_chunk_select()))
def q_split_unknown_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R9 — an unknown method name falls back to sampling."""
    df = _events_id(spark, sf_dir)
    return _per_chunk(df, splits.split(df, "key", 5, method="by-moon-phase"))


# --------------------------------------------------------------------------
# R7 — small-table gate


@register("split_small_gate",
          with_src("SELECT page_id AS key, * FROM pages", sp_count(10), assigned(),
                   chunk_report_select()))
def q_split_small_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read_table(spark, sf_dir, "pages").withColumnRenamed("page_id", "key")
    return chunks.chunk_report(df, splits.split_count(df, "key", 10, small_rows=splits.SMALL_TABLE_ROWS))


@register("split_count_wide",
          with_src("SELECT event_id AS key, * FROM events", sp_count(25), assigned(),
                   chunk_report_select()))
def q_split_count_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More chunks than the default: the number asked for is honoured."""
    df = read_table(spark, sf_dir, "events").withColumnRenamed("event_id", "key")
    return chunks.chunk_report(df, splits.split_count(df, "key", 25))


@register("split_count_narrow",
          with_src("SELECT l_orderkey AS key, * FROM lineitem", sp_count(10), assigned(),
                   chunk_report_select()))
def q_split_count_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The narrowing path at every size: windows of 500 rows, 8 edges a level."""
    df = read_table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "key")
    return chunks.chunk_report(df, splits.split_count(df, "key", 10, window_rows=500, fanout=8))


# --------------------------------------------------------------------------
# X1/S3 — chunk assignment, row level


@register("chunk_assign", with_src(EVENTS_HEX, sp_count(10), assigned(),
                                   "SELECT event_id, key, chunk FROM asg"))
def q_chunk_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = events_with_key(spark, sf_dir, "key")
    ranges = splits.split_count(df, "key", 10)
    return splits.with_chunk(df, ranges).select("event_id", "key", "chunk")


# --------------------------------------------------------------------------
# S2/P1 — one range-filtered scan per chunk, unioned (every chunk scanned)


@register("chunk_scan", with_src(EVENTS_ID, sp_count(10), assigned(), per_chunk_select(
    ", round(sum(value), 4) AS value_sum")))
def q_chunk_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _events_id(spark, sf_dir)
    ranges = splits.split_count(df, "key", 10)
    out = None
    for i in range(ranges.n_chunks):
        part = (chunks.chunk_scan(df, ranges, i)
                .agg(F.lit(i).alias("chunk"), F.count(F.lit(1)).alias("rows"),
                     F.min("key").alias("min_key"), F.max("key").alias("max_key"),
                     F.round(F.sum("value"), 4).alias("value_sum")))
        out = part if out is None else out.unionByName(part)
    return out


# --------------------------------------------------------------------------
# A1/A2 — key bounds


@register("key_bounds", f"""
WITH src AS ({EVENTS_HEX})
SELECT CAST(count(*) AS BIGINT) AS rows, min(key) AS min_key, max(key) AS max_key,
       min(sec) AS min_sec, max(sec) AS max_sec FROM src""")
def q_key_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = events_with_key(spark, sf_dir, "key")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.min("key").alias("min_key"),
                  F.max("key").alias("max_key"),
                  F.min(key_seconds("key")).alias("min_sec"),
                  F.max(key_seconds("key")).alias("max_sec"))


# --------------------------------------------------------------------------
# X2 — exactly-once cover


@register("chunk_cover", with_src(EVENTS_HEX, sp_time(10), assigned(), """
SELECT chunk, CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT key) AS BIGINT) AS distinct_keys,
       min(key) AS min_key, max(key) AS max_key,
       CAST(sum(count(*)) OVER () AS BIGINT) AS total_rows
FROM asg GROUP BY chunk"""))
def q_chunk_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = events_with_key(spark, sf_dir, "key")
    return chunks.chunk_cover(df, splits.split_time(df, "key", 10))


# --------------------------------------------------------------------------
# X3 — empty chunks reported (time split of a key with a gap in time)

GAP_SHIFT = 400 * 86400  # errors are stamped 400 days later: a hole in time


def _gapped_key_spark(df: DataFrame) -> DataFrame:
    sec = epoch_seconds("ts") + F.when(F.col("event_type") == "error", F.lit(GAP_SHIFT)) \
        .otherwise(F.lit(0))
    key = F.concat(F.lpad(F.lower(F.hex(sec)), 8, "0"),
                   F.lpad(F.lower(F.hex("event_id")), 16, "0"))
    return df.withColumn("key", key)


GAPPED_SRC = f"""
SELECT format('{{:08x}}', sec) || format('{{:016x}}', event_id) AS key, sec, * FROM (
  SELECT epoch_us(ts) // 1000000 + CASE WHEN event_type = 'error' THEN {GAP_SHIFT} ELSE 0 END AS sec, *
  FROM events)"""


@register("chunk_empty", with_src(GAPPED_SRC, sp_time(10), assigned(), chunk_report_select()))
def q_chunk_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _gapped_key_spark(read_table(spark, sf_dir, "events"))
    report = chunks.chunk_report(df, splits.split_time(df, "key", 10))
    return chunks.guard_empty_chunks(report, on_empty="allow")


# --------------------------------------------------------------------------
# X4 — balance of the three methods on one table

BALANCE_SQL = f"""
WITH src AS ({EVENTS_HEX}),
{sp_count(10).replace('sp AS', 'sp_c AS')},
{sp_time(10).replace('sp AS', 'sp_t AS')},
{sp_sample_all(10).replace('sp AS', 'sp_s AS')},
cnt AS (
  SELECT 'count' AS method, (SELECT count(*) FROM sp_c WHERE sp_c.key <= s.key) AS chunk FROM src s
  UNION ALL
  SELECT 'time', (SELECT count(*) FROM sp_t WHERE sp_t.key <= s.key) FROM src s
  UNION ALL
  SELECT 'sampling', (SELECT count(*) FROM sp_s WHERE sp_s.key <= s.key) FROM src s),
per AS (SELECT method, chunk, count(*) AS rows FROM cnt GROUP BY method, chunk)
SELECT method, CAST(count(*) AS BIGINT) AS chunks, CAST(min(rows) AS BIGINT) AS min_rows,
       CAST(max(rows) AS BIGINT) AS max_rows, CAST(sum(rows) AS BIGINT) AS total_rows,
       round(max(rows) * count(*) / sum(rows), 6) AS imbalance
FROM per GROUP BY method"""


@register("chunk_balance", BALANCE_SQL)
def q_chunk_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = events_with_key(spark, sf_dir, "key")
    frames = {m: (df, splits.split(df, "key", 10, method=m))
              for m in ("count", "time", "sampling")}
    return chunks.chunk_balance(frames)


# --------------------------------------------------------------------------
# X5 — creation-time profile of the keys


@register("key_time_profile", f"""
WITH src AS ({EVENTS_HEX})
SELECT CAST(sec // 86400 * 86400 AS BIGINT) AS period_start, CAST(count(*) AS BIGINT) AS rows
FROM src GROUP BY 1""")
def q_key_time_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = events_with_key(spark, sf_dir, "key")
    return chunks.key_time_profile(df, "key", "day")


# --------------------------------------------------------------------------
# R5/R6/S7 — save a range table, read it back (validated), split by it


@register("ranges_roundtrip", with_src(EVENTS_HEX, sp_sample_all(10), assigned(),
                                       chunk_report_select()))
def q_ranges_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = events_with_key(spark, sf_dir, "key")
    made = splits.split_sample(df, "key", 10)
    path = scratch_path(spark, "ranges") + "/events.json"
    range_files.write_ranges(spark, made, path)
    loaded = range_files.read_ranges(spark, path, key="key")
    used = splits.split(df, "key", 3, method="time", ranges=loaded)
    return chunks.chunk_report(df, used)


@register("ranges_numeric", with_src(EVENTS_ID, sp_count(8, 0), assigned(), chunk_report_select()))
def q_ranges_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7/R6 — ranges of numeric keys keep their type in the file."""
    df = _events_id(spark, sf_dir)
    path = scratch_path(spark, "ranges") + "/events.json"
    range_files.write_ranges(spark, splits.split_count(df, "key", 8), path)
    return chunks.chunk_report(df, range_files.read_ranges(spark, path, key="key"))


# --------------------------------------------------------------------------
# X1 — a range table with as many ranges as there are orders


@register("chunk_assign_table", """
WITH p AS (SELECT o_orderkey AS start_id, row_number() OVER (ORDER BY o_orderkey) - 1 AS chunk FROM orders WHERE o_orderkey % 3 <> 0)
SELECT l.l_orderkey, l.l_linenumber, CAST(coalesce(p.chunk, -1) AS BIGINT) AS chunk
FROM lineitem l ASOF LEFT JOIN p ON l.l_orderkey >= p.start_id""")
def q_chunk_assign_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts = read_table(spark, sf_dir, "orders").where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("start_id"))
    numbered = starts.withColumn("chunk", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("start_id")).cast("long") - 1)
    rows = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return chunks.assign_by_table(rows, "l_orderkey", numbered).withColumn("chunk", F.coalesce("chunk", F.lit(-1).cast("long")))


# --------------------------------------------------------------------------
# R3/O3 — the sample of a table larger than it


@register("sample_keys", """
SELECT l_orderkey * 10 + l_linenumber AS key FROM lineitem
ORDER BY md5(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) || ':42'), key LIMIT 10000""")
def q_sample_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read_table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("key"))
    return spark.createDataFrame([(k,) for k in splits.sample_keys(df, "key")], "key long")


# --------------------------------------------------------------------------
# X2 — published rows against the source, by fingerprint

PUBLISHED = """
WITH a AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders),
b AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 1000 = 7 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
      FROM a WHERE o_orderkey % 1000 <> 11 UNION ALL SELECT * FROM a WHERE o_orderkey % 1000 = 13)"""


def _published(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    a = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    kind = F.col("o_orderkey") % 1000
    price = F.when(kind == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return a, a.where(kind != 11).withColumn("o_totalprice", price).unionAll(a.where(kind == 13))


@register("reconcile_rows", PUBLISHED + """
SELECT *, CAST(sum(s) AS BIGINT) AS surplus FROM (SELECT *, -1 AS s FROM a UNION ALL SELECT *, 1 FROM b)
GROUP BY o_orderkey, o_custkey, o_totalprice HAVING sum(s) <> 0""".replace("SELECT *, CAST(sum", "SELECT o_orderkey, o_custkey, o_totalprice, CAST(sum"))
def q_reconcile_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2 — changed, lost and doubled rows are each found."""
    a, b = _published(spark, sf_dir)
    return chunks.differences(a, b, splits.split_count(a, "o_orderkey", 20))


@register("reconcile_chunks", PUBLISHED + """,
src AS (SELECT o_orderkey AS key FROM a),""" + sp_count(20, 0) + """,
c AS (SELECT CAST((SELECT count(*) FROM sp WHERE sp.key <= o_orderkey) AS INTEGER) AS chunk, s, o_orderkey, o_custkey, o_totalprice
      FROM (SELECT *, 0 AS s FROM a UNION ALL SELECT *, 1 FROM b)),
d AS (SELECT chunk, sum(s - (1 - s)) AS n FROM c GROUP BY chunk, o_orderkey, o_custkey, o_totalprice)
SELECT c.chunk, CAST(sum(1 - s) AS BIGINT) AS source_rows, CAST(sum(s) AS BIGINT) AS published_rows,
       any_value(x.same) AS same
FROM c JOIN (SELECT chunk, bool_and(n = 0) AS same FROM d GROUP BY chunk) x ON x.chunk = c.chunk GROUP BY c.chunk""")
def q_reconcile_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _published(spark, sf_dir)
    return chunks.reconcile(a, b, splits.split_count(a, "o_orderkey", 20))
