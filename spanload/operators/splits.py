"""Key-range splitting.

A split turns a table into ``n`` contiguous, half-open key ranges
``[start, end)``; the first start and the last end are open.  The result is
a :class:`KeyRanges` — a handful of split points held on the driver — so
that chunk assignment (X1) is a narrow expression over literals instead of a
join.  Three methods:

* ``count``    — exact: split point k is the key of the (k·per)-th row in
  key order, per = max(1, rows // n).  Distributed order statistics.
* ``time``     — boundaries at equal fractions of the creation-time span of
  object-id keys; no sort at all (one min/max pass).
* ``sampling`` — 10,000 random keys, sorted and de-duplicated; split point i
  is ``sample[i * len // n]``.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DataType, IntegerType, StringType, StructField,
                               StructType)

from spanload.functions.keys import boundary_key, is_hex_key
from spanload.operators.order_stats import (bucket_search, count_and_sketch, order_statistics, rank_tree,
                                           typed_lit)

log = logging.getLogger(__name__)

# Chunk-number policy, the small-table gate and the sample size.
DEFAULT_CHUNKS = 10
SMALL_TABLE_ROWS = 1000  # a gate that callers may name; off by default
TREE_POINTS = 500  # more points than this are searched in an array: generated code stays small
SAMPLE_SIZE = 10000
METHODS = ("time", "sampling", "count")


@dataclass
class KeyRanges:
    """Ascending split points; chunk i covers ``[points[i-1], points[i])``."""

    key: str
    dtype: DataType
    points: list[Any] = field(default_factory=list)
    method: str = "single"

    @property
    def n_chunks(self) -> int:
        return len(self.points) + 1

    def bounds(self, chunk: int) -> tuple[Any, Any]:
        lo = self.points[chunk - 1] if chunk > 0 else None
        hi = self.points[chunk] if chunk < len(self.points) else None
        return lo, hi

    def chunk_of(self, key: str | Column | None = None) -> Column:
        """X1 — chunk number of each row: count of split points <= key."""
        k = F.col(key or self.key) if not isinstance(key, Column) else key
        if not self.points:
            return F.lit(0)
        if len(self.points) > TREE_POINTS:
            return bucket_search(k, self.points, self.dtype, point=False)
        return rank_tree(k, [typed_lit(p, self.dtype) for p in self.points])

    def predicate(self, chunk: int, key: str | Column | None = None) -> Column:
        """P1 — ``start <= key < end`` with open sides left out."""
        k = F.col(key or self.key) if not isinstance(key, Column) else key
        lo, hi = self.bounds(chunk)
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (k >= typed_lit(lo, self.dtype))
        if hi is not None:
            cond = cond & (k < typed_lit(hi, self.dtype))
        return cond

    def to_df(self, spark: SparkSession) -> DataFrame:
        """The range table ``(chunk, start_id, end_id)``; NULL = open side."""
        schema = StructType([StructField("chunk", IntegerType(), False),
                             StructField("start_id", self.dtype, True),
                             StructField("end_id", self.dtype, True)])
        rows = [(i, *self.bounds(i)) for i in range(self.n_chunks)]
        return spark.createDataFrame(rows, schema)


def chunk_policy(n: int | None, cap: int | None = None) -> int:
    """R8 — <= 0 or absent → default; above a cap that the caller names → an error."""
    if n is None or n <= 0:
        return DEFAULT_CHUNKS if cap is None else min(DEFAULT_CHUNKS, cap)
    if cap is not None and n > cap:
        raise ValueError(f"{n} chunks asked for, the limit is {cap}")
    return n


def _single(key: str, dtype: DataType) -> KeyRanges:
    return KeyRanges(key, dtype, [], "single")


def _dedupe(points: list[Any]) -> list[Any]:
    out: list[Any] = []
    for p in points:
        if not out or p != out[-1]:
            out.append(p)
    return out


def _count_and_nulls(df: DataFrame, key: str, extra: list[Column] | None = None):
    aggs = [F.count(F.lit(1)).alias("rows"), F.count(F.col(key)).alias("nonnull")]
    return _refuse_nulls(df.select(key).agg(*(aggs + (extra or []))).first(), key)


def _refuse_nulls(row, key: str):
    if row["rows"] != row["nonnull"]:
        raise ValueError(f"{row['rows'] - row['nonnull']} rows have a null key {key!r}")
    return row


def split_count(df: DataFrame, key: str, n: int | None = None, *,
                cap: int | None = None, small_rows: int = 0,
                **stats_opts) -> KeyRanges:
    """R1 — exact split by row count."""
    dtype = df.schema[key].dataType
    n = chunk_policy(n, cap)
    if n == 1:
        return _single(key, dtype)
    # The counting pass also sketches the keys around every split point.
    row = _refuse_nulls(count_and_sketch(df, key, [i / n for i in range(1, n)]), key)
    total = row["rows"]
    if total < 1:
        raise ValueError(f"no rows to split by {key!r}")
    if total < small_rows:
        return _single(key, dtype)
    per = max(1, total // n)
    # a split point exists only for ordinals the scan reaches
    ordinals = [i * per for i in range(1, n) if i * per <= total]
    if not ordinals:
        return _single(key, dtype)
    stats_opts.setdefault("first", (row["below"][:len(ordinals)], row["above"][:len(ordinals)]))
    found = order_statistics(df.select(key), key, ordinals, total=total, **stats_opts)
    return KeyRanges(key, dtype, _dedupe([found[o] for o in ordinals]), "count")


def time_boundaries(oldest: int, newest: int, n: int) -> list[int]:
    """Boundary seconds of a time split: oldest + trunc(span_ns * i / n), whole seconds."""
    span_ns = (newest - oldest) * 1_000_000_000
    return [oldest + int(float(span_ns) * (float(i) / float(n))) // 1_000_000_000
            for i in range(1, n)]


def split_time(df: DataFrame, key: str, n: int | None = None, *,
               cap: int | None = None, small_rows: int = 0) -> KeyRanges:
    """R2 — split by the creation-time span of object-id keys (one pass)."""
    dtype = df.schema[key].dataType
    n = chunk_policy(n, cap)
    if n == 1:
        return _single(key, dtype)
    if not isinstance(dtype, StringType):
        raise ValueError(f"time split needs object-id keys; {key!r} is {dtype.simpleString()}")
    row = _count_and_nulls(df, key, [
        F.min(key).alias("lo"), F.max(key).alias("hi"),
        F.sum(F.when(~is_hex_key(key), 1).otherwise(0)).alias("bad")])
    if row["rows"] < 1:
        raise ValueError(f"no rows to take creation times of {key!r} from")
    if row["bad"]:
        raise ValueError(f"{row['bad']} keys of {key!r} are not object ids")
    if row["rows"] < small_rows:
        n = 1
    oldest = int(row["lo"][:8], 16)
    newest = int(row["hi"][:8], 16)
    if newest - oldest <= 0 or n == 1:
        return _single(key, dtype)
    points = [boundary_key(s) for s in time_boundaries(oldest, newest, n)]
    return KeyRanges(key, dtype, _dedupe(points), "time")


def sample_keys(df: DataFrame, key: str, size: int = SAMPLE_SIZE, seed: int = 42,
                total: int | None = None) -> list[Any]:
    """``size`` random keys (all keys when the table has no more than that).

    Those of least MD5 of the key and ``seed``: each task keeps its least ``size``, merged at the
    end, so the sample doesn't depend on files, partitions or order.  Keys of a table are
    its rows' identities; one that several rows share is drawn as often, or not at all.
    """
    keys = df.select(F.col(key).alias("k"))
    if total is None:
        total = keys.count()
    if total <= size:
        return [r[0] for r in keys.collect()]
    drawn = F.md5(F.concat(F.col("k").cast("string"), F.lit(f":{seed}")))
    return [r[0] for r in keys.orderBy(drawn, "k").limit(size).collect()]


def split_sample(df: DataFrame, key: str, n: int | None = None, *,
                 cap: int | None = None, size: int = SAMPLE_SIZE,
                 seed: int = 42) -> KeyRanges:
    """R3/R4 — split points from a sorted, de-duplicated random sample."""
    dtype = df.schema[key].dataType
    n = chunk_policy(n, cap)
    if n == 1:
        return _single(key, dtype)
    total = _count_and_nulls(df, key)["rows"]
    samples = sorted(set(sample_keys(df, key, size, seed, total)))
    if not samples:
        return _single(key, dtype)
    if len(samples) < n + 1:
        log.warning("the sample has too few distinct keys for %d ranges, making %d", n, len(samples) - 1)
        n = len(samples) - 1
        if n <= 0:
            return _single(key, dtype)
    points = [samples[min((i * len(samples)) // n, len(samples) - 1)] for i in range(1, n)]
    return KeyRanges(key, dtype, _dedupe(points), "sampling")


def split(df: DataFrame, key: str, n: int | None = None, method: str | None = None, *,
          ranges: KeyRanges | None = None, cap: int | None = None, **opts) -> KeyRanges:
    """R5/R9/R10 — method dispatch; a given range table overrides everything."""
    if ranges is not None:
        return ranges
    method = method or "time"
    n = chunk_policy(n, cap)
    if n == 1:
        return _single(key, df.schema[key].dataType)
    small_rows = opts.pop("small_rows", 0)
    if method == "time":
        return split_time(df, key, n, cap=cap, small_rows=small_rows, **opts)
    if method == "count":
        return split_count(df, key, n, cap=cap, small_rows=small_rows, **opts)
    if method != "sampling":
        log.warning("unknown split method %r, using sampling", method)
    return split_sample(df, key, n, cap=cap, **opts)  # R7: no small-table gate here


def with_chunk(df: DataFrame, ranges: KeyRanges, name: str = "chunk") -> DataFrame:
    """X1 — add the chunk column (narrow; no join, no shuffle)."""
    return df.withColumn(name, ranges.chunk_of())
