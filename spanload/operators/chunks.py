"""Range predicates, chunk reports and guards.

A chunk is a label, not the unit of work: Spark still splits the input into
its own tasks.  All reports below are single aggregations that end in a few
rows per chunk; the tiny range table is joined with an explicit broadcast
whose size is bounded by the chunk cap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanload.functions.keys import key_seconds
from spanload.operators.order_stats import bucket_search
from spanload.operators.splits import KeyRanges, with_chunk


def chunk_scan(df: DataFrame, ranges: KeyRanges, chunk: int) -> DataFrame:
    """S2/P1 — the rows of one chunk; the range filter reaches the parquet scan."""
    return df.where(ranges.predicate(chunk))


def key_bounds(df: DataFrame, key: str) -> DataFrame:
    """A1/A2 — rows, min and max key in one pass."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("min_key"),
                  F.max(key).alias("max_key"))


def chunk_counts(df: DataFrame, ranges: KeyRanges) -> DataFrame:
    """Rows, distinct keys and key bounds per chunk (one aggregation)."""
    k = ranges.key
    return (with_chunk(df.select(k), ranges)
            .groupBy("chunk")
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.count_distinct(k).alias("distinct_keys"),
                 F.min(k).alias("min_key"), F.max(k).alias("max_key")))


def chunk_cover(df: DataFrame, ranges: KeyRanges) -> DataFrame:
    """X2 — per-chunk rows plus whole-table totals for the exactly-once check.

    ``rows`` summed over chunks must equal ``total_rows`` and ``distinct_keys``
    must equal ``rows`` when keys are unique.  Totals come from the same
    aggregation via a window over the (at most cap) chunk rows.
    """
    counts = chunk_counts(df, ranges)
    w = Window.partitionBy(F.lit(1))
    return counts.withColumn("total_rows", F.sum("rows").over(w))


def check_cover(df: DataFrame, ranges: KeyRanges, expected_rows: int | None = None) -> dict:
    """X2 as an assertion: every row in exactly one chunk, no duplicate key."""
    rows = chunk_counts(df, ranges).collect()
    total = sum(r["rows"] for r in rows)
    distinct = sum(r["distinct_keys"] for r in rows)
    if expected_rows is not None and total != expected_rows:
        raise AssertionError(f"chunks hold {total} rows, input has {expected_rows}")
    for r in rows:
        lo, hi = ranges.bounds(r["chunk"])
        if (lo is not None and r["min_key"] < lo) or (hi is not None and r["max_key"] >= hi):
            raise AssertionError(f"chunk {r['chunk']} holds keys outside its range")
    return {"rows": total, "distinct_keys": distinct, "chunks": len(rows)}


def chunk_report(df: DataFrame, ranges: KeyRanges) -> DataFrame:
    """X3 — every range with its row count, zero for empty chunks."""
    counts = (with_chunk(df.select(ranges.key), ranges)
              .groupBy("chunk").agg(F.count(F.lit(1)).alias("rows")))
    table = F.broadcast(ranges.to_df(df.sparkSession))
    return (table.join(counts, "chunk", "left")
            .select("chunk", "start_id", "end_id",
                    F.coalesce(F.col("rows"), F.lit(0)).cast("bigint").alias("rows")))


def guard_empty_chunks(report: DataFrame, on_empty: str = "error") -> DataFrame:
    """X3 — fail the table when a chunk is empty (``on_empty='error'``).

    The check runs inside the plan (``assert_true``), so it fires at the
    write action without a separate pass.
    """
    if on_empty == "allow":
        return report
    if on_empty != "error":
        raise ValueError("on_empty must be 'error' or 'allow'")
    check = F.assert_true(F.col("rows") > 0, F.concat(F.lit("empty range: chunk "),
                                                      F.col("chunk").cast("string")))
    # A filter, so column pruning cannot remove the check.
    return report.where(check.isNull())


def chunk_balance(frames: dict[str, tuple[DataFrame, KeyRanges]]) -> DataFrame:
    """X4 — per method: chunks, min/max/avg rows and max/avg imbalance.

    Methods on one frame share one scan: each row is labelled by all of them at once."""
    parts = []
    by_frame: dict[int, tuple[DataFrame, dict[str, KeyRanges]]] = {}
    for method, (df, ranges) in frames.items():
        by_frame.setdefault(id(df), (df, {}))[1][method] = ranges
    for df, methods in by_frame.values():
        label = F.explode(F.array(*[F.struct(F.lit(m).alias("method"), r.chunk_of().cast("int").alias("chunk"))
                                    for m, r in methods.items()])).alias("x")
        counts = df.select(label).groupBy("x.method", "x.chunk").agg(F.count(F.lit(1)).alias("rows"))
        every = df.sparkSession.createDataFrame([(m, r.n_chunks) for m, r in methods.items()], "method string, n int")
        every = every.select("method", F.explode(F.expr("sequence(0, n - 1)")).alias("chunk"))
        parts.append(every.join(counts, ["method", "chunk"], "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
                     .groupBy("method").agg(F.count(F.lit(1)).alias("chunks"), F.min("rows").alias("min_rows"),
                                            F.max("rows").alias("max_rows"), F.sum("rows").alias("total_rows")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn(
        "imbalance", F.round(F.col("max_rows") * F.col("chunks") / F.col("total_rows"), 6))


# Points of a range table that are searched together, and buckets of them at most.
POINTS_TOGETHER, MOST_BUCKETS = 2048, 1 << 14


def assign_by_table(df: DataFrame, key: str, table: DataFrame, name: str = "chunk") -> DataFrame:
    """X1 for range tables of any size — add the number of the range that holds each row's key.

    ``table``: ``chunk`` (0, 1, 2 ...) and ``start_id``, ascending together; a null start is open.
    Neighbouring ranges are put into buckets, of which only the first starts are literals
    (``MOST_BUCKETS`` at most); rows meet their bucket by an equi-join, and its starts are
    searched in halves there.  A key that very many rows have makes one large join key, which
    adaptive execution splits.  Rows with a null key, or one before the first start, get null.
    """
    n = (table.agg(F.max("chunk")).first()[0] or 0) + 1
    size = max(POINTS_TOGETHER, -(-n // MOST_BUCKETS))
    starts = table.select(F.floor(F.col("chunk") / size).cast("int").alias("_b"), "chunk", "start_id")
    buckets = starts.groupBy("_b").agg(F.sort_array(F.collect_list(F.struct("chunk", "start_id"))).alias("_s"))
    dtype = df.schema[key].dataType
    firsts = [r[0] for r in table.where((F.col("chunk") % size == 0) & (F.col("chunk") > 0)).orderBy("chunk")
              .select("start_id").collect()]
    bucket = bucket_search(F.col(key), firsts, dtype, point=False) if firsts else F.lit(0)
    rows = df.withColumn("_b", F.when(F.col(key).isNotNull(), bucket.cast("int")))
    powers = F.array(*[F.lit(1 << i) for i in reversed(range(size.bit_length()))])

    def half(at, step):
        start = F.get(F.col("_s"), at + step - 1)
        return F.when((at + step <= F.size("_s")) & (start["start_id"].isNull() | (start["start_id"] <= F.col(key))),
                      at + step).otherwise(at)

    place = F.aggregate(powers, F.lit(0), half)
    return (rows.join(buckets, "_b", "left")
            .withColumn(name, F.when(F.col("_s").isNotNull(), F.get(F.col("_s"), place - 1)["chunk"]))
            .drop("_b", "_s"))


# ---- reconciliation ---------------------------------------------------------------------------


def fingerprints(df: DataFrame, ranges: KeyRanges) -> DataFrame:
    """X2 — rows per chunk and two sums of row hashes, which don't depend on the rows' order.

    A lost, doubled or changed row changes them; sums are exact (no overflow, no rounding)."""
    cols = [F.col(f"`{c}`") for c in sorted(df.columns)]
    null = F.concat_ws(",", *[c.isNull().cast("string") for c in cols])  # a hash passes nulls over

    def total(seed: int):
        return F.sum(F.xxhash64(F.lit(seed), null, *cols).cast("decimal(20,0)"))

    return (with_chunk(df, ranges).groupBy("chunk")
            .agg(F.count(F.lit(1)).alias("rows"), total(1).alias("one"), total(2).alias("two")))


def reconcile(source: DataFrame, published: DataFrame, ranges: KeyRanges) -> DataFrame:
    """X2 — rows of each chunk on both sides, and whether they are the same rows."""
    a, b = (fingerprints(d.select(*sorted(source.columns)), ranges) for d in (source, published))
    both = a.select("chunk", *[F.col(c).alias(f"a_{c}") for c in ("rows", "one", "two")]).join(
        b.select("chunk", *[F.col(c).alias(f"b_{c}") for c in ("rows", "one", "two")]), "chunk", "full")
    same = F.lit(True)
    for c in ("rows", "one", "two"):
        same = same & F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
    return both.select("chunk", F.coalesce("a_rows", F.lit(0)).alias("source_rows"),
                       F.coalesce("b_rows", F.lit(0)).alias("published_rows"), same.alias("same"))


def differences(source: DataFrame, published: DataFrame, ranges: KeyRanges) -> DataFrame:
    """X2 — the rows that one side has more often, with ``surplus``: how many more the published side
    has (negative: lost).  Only chunks whose fingerprints differ are compared row by row."""
    cols = sorted(source.columns)
    differ = [r["chunk"] for r in reconcile(source, published, ranges).where("not same").collect()]  # chunks: few
    sides = [with_chunk(d.select(*cols), ranges).where(F.col("chunk").isin(differ)).withColumn("_side", F.lit(v).cast("long"))
             for d, v in ((source, -1), (published, 1))]
    return (sides[0].unionByName(sides[1]).groupBy(*cols).agg(F.sum("_side").alias("surplus")).where("surplus <> 0"))


# Period lengths of the key-time profile, in seconds.
PROFILE_UNITS = {"minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def key_time_profile(df: DataFrame, key: str, unit: str = "day") -> DataFrame:
    """X5 — rows per creation-time period of object-id keys (skew check for ``time``).

    Periods are whole UTC units counted from 1970 (``period_start`` in epoch
    seconds), so the result does not depend on the session time zone.
    """
    if unit not in PROFILE_UNITS:
        raise ValueError(f"unit must be one of {sorted(PROFILE_UNITS)}")
    size = PROFILE_UNITS[unit]
    start = (F.floor(key_seconds(key) / size) * size).cast("bigint")
    return (df.select(start.alias("period_start"))
            .groupBy("period_start").agg(F.count(F.lit(1)).alias("rows")))
