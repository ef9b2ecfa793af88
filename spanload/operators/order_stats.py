"""Exact order statistics without a single-partition window over the table.

``row_number() over (order by key)`` pulls every row into one task.  This
module finds the key at given 1-based ordinals of the ascending key order in
few scans, whatever the number of rows:

1. one aggregation counts the rows and builds a KLL sketch of the keys, a
   mergeable summary whose ranks are off by a known share of the rows at
   most (99 % of the time; three times that is allowed for).  It gives, for
   each ordinal, an interval of keys that all but surely holds it;
2. one grouped count finishes: rows between the intervals are counted as
   they are, rows inside by key, so a hot key is one row before the shuffle;
   a running sum over each interval's keys finds the ordinal.

Between the two, intervals that may hold more than ``window_rows`` rows are
counted and sketched again by themselves, which shrinks them some
hundredfold a scan.  An ordinal that is not in its interval after all (the
counts are exact, so that is seen) is looked for where the counts say it is.

The sketch works on numbers: a key's *image*, an order-preserving number.
Integers, decimals of up to 18 digits, dates and times have exact ones;
strings and bytes give seven bytes, from where the interval's bounds begin
to differ.  Images only steer the work; answers are keys that were counted.
Only sketched quantiles, counts and answers reach the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, BooleanType, ByteType, CharType, DataType, DateType, DecimalType,
                               DoubleType, FloatType, IntegerType, LongType, ShortType, StringType,
                               StructType, TimestampNTZType, TimestampType, VarcharType)

#: Items that a sketch keeps at its widest level, and quantiles taken from one.
SKETCH_SIZE, GRID = 8192, 2000
PREFIX = 7  # bytes of a string that fit a long
TREE_EDGES = 255  # more edges than this are searched in an array: generated code stays small


def typed_lit(value: Any, dtype: DataType) -> Column:
    return F.lit(value).cast(dtype)


def rank_tree(k: Column, edges: list[Column], point: bool = False) -> Column:
    """Number of edges ``<= k`` as a balanced CASE tree (log2 comparisons/row).

    With ``point=True`` the result is a bucket index in which every edge has
    its own bucket: 0 = below the first edge, 2i-1 = equal to edge i,
    2i = strictly between edge i and edge i+1.
    """

    def leaf(i: int) -> Column:
        if not point or i == 0:
            return F.lit(i)
        return F.when(k == edges[i - 1], F.lit(2 * i - 1)).otherwise(F.lit(2 * i))

    def build(lo: int, hi: int) -> Column:
        if lo == hi:
            return leaf(lo)
        mid = (lo + hi + 1) // 2
        return F.when(k >= edges[mid - 1], build(mid, hi)).otherwise(build(lo, mid - 1))

    return build(0, len(edges))


def array_rank(k: Column, values: Column, n: Column | int, most: int) -> Column:
    """How many of a sorted array's ``n`` values are ``<= k``; the array has ``most`` at most."""
    powers = F.array(*[F.lit(1 << i) for i in reversed(range(most.bit_length()))])
    return F.aggregate(powers, F.lit(0), lambda at, p: F.when(
        (at + p <= n) & (F.get(values, at + p - 1) <= k), at + p).otherwise(at))


def bucket_search(k: Column, edges: list, dtype, point: bool = True) -> Column:
    """The bucket that :func:`rank_tree` gives, by a binary search over a literal array.

    Steps and generated code grow with the logarithm of the number of edges.
    """
    n = len(edges)
    values = F.array(*[typed_lit(e, dtype) for e in edges])
    below = array_rank(k, values, n, n)
    if not point:
        return below
    return F.when((below > 0) & (F.get(values, below - 1) == k), 2 * below - 1).otherwise(2 * below)


def image(k: Column, dtype: DataType, skip: int = 0) -> tuple[Column, bool]:
    """An order-preserving number of the key (greater keys never have lesser ones), and whether
    it is a double (else a long).  ``skip``: leading bytes of strings to leave out."""
    if isinstance(dtype, (ByteType, ShortType, IntegerType, LongType, BooleanType)):
        return k.cast("long"), False
    if isinstance(dtype, DateType):
        return F.unix_date(k).cast("long"), False
    if isinstance(dtype, TimestampType):
        return F.unix_micros(k), False
    if isinstance(dtype, TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), k), False
    if isinstance(dtype, DecimalType) and dtype.precision <= 18:
        return (k * F.lit(10 ** dtype.scale).cast(DecimalType(19, 0))).cast("long"), False
    if isinstance(dtype, (FloatType, DoubleType, DecimalType)):
        return k.cast("double"), True
    if isinstance(dtype, (StringType, BinaryType, CharType, VarcharType)):
        some = F.hex(F.substring(k.cast("binary"), skip + 1, PREFIX))
        return F.conv(F.rpad(some, 2 * PREFIX, "0"), 16, 10).cast("long"), False
    if isinstance(dtype, StructType) and dtype.fields:
        first = dtype.fields[0]
        return image(F.coalesce(k[first.name], F.lit(None).cast(first.dataType)), first.dataType, skip)
    raise ValueError(f"keys of type {dtype.simpleString()} can't be split by count")


def rank_error(size: int) -> float:
    """Share of the rows that a KLL sketch's rank is off by, with some room."""
    return 3 * 2.296 / size ** 0.9723


@dataclass
class _Piece:
    """Keys from ``lo`` to ``hi`` (None: open), ``base`` rows below them, ``count`` rows in them."""

    lo: Any
    hi: Any
    base: int
    count: int
    targets: list[int]
    skip: int = 0
    #: disjoint intervals of images that should hold the targets; none: nothing is known
    spans: list[tuple] = field(default_factory=list)
    #: rows that a span may hold
    most: float = math.inf

    def holds(self, k: Column, dtype: DataType) -> Column:
        cond = F.lit(True)
        if self.lo is not None:
            cond = cond & (k >= typed_lit(self.lo, dtype))
        if self.hi is not None:
            cond = cond & (k <= typed_lit(self.hi, dtype))
        return cond

    def bucket(self, k: Column, dtype: DataType) -> Column:
        """Odd: in a span (the only one, 1, where there are none); even: between spans."""
        if not self.spans:
            return F.lit(1)
        g, as_double = image(k, dtype, self.skip)
        after = (lambda x: math.nextafter(x, math.inf)) if as_double else (lambda x: x + 1)
        edges = [e for a, b in self.spans for e in (a, after(b))]
        number = DoubleType() if as_double else LongType()
        if len(edges) > TREE_EDGES:
            return bucket_search(g, edges, number, point=False)
        return rank_tree(g, [typed_lit(e, number) for e in edges])


def _spans(pairs: list[tuple]) -> list[tuple]:
    """Sorted and disjoint: intervals that overlap are put together."""
    out: list[tuple] = []
    for a, b in sorted(pairs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        elif b < (1 << 63) - 1:
            out.append((a, b))
        else:  # nothing comes after the greatest long
            out.append((a, b - 1))
    return out


def count_and_sketch(df: DataFrame, key: str, fractions: list[float], size: int = SKETCH_SIZE):
    """One scan: ``rows``, ``nonnull`` (rows with a key), and the images ``below`` and ``above``
    between which the keys at ``fractions`` of all rows should lie."""
    g, as_double = image(F.col(key), df.schema[key].dataType)
    sketch = (F.kll_sketch_agg_double if as_double else F.kll_sketch_agg_bigint)(g, F.lit(size))
    quantile = F.kll_sketch_get_quantile_double if as_double else F.kll_sketch_get_quantile_bigint
    error = 2 * rank_error(size)

    def at(by: float) -> Column:
        ranks = F.array(*[F.lit(min(1.0, max(0.0, f + by))) for f in fractions])
        return F.when(F.col("nonnull") > 0, quantile("sketch", ranks))

    return (df.select(key).agg(F.count(F.lit(1)).alias("rows"), F.count(F.col(key)).alias("nonnull"), sketch.alias("sketch"))
            .select("rows", "nonnull", at(-error).alias("below"), at(error).alias("above")).first())


def order_statistics(keys_df: DataFrame, key: str, ordinals: list[int], *,
                     total: int | None = None, window_rows: int = 1 << 22,
                     fanout: int = GRID, sample_rows: int = SKETCH_SIZE,
                     max_levels: int = 64, first: tuple[list, list] | None = None) -> dict[int, Any]:
    """Exact key value at each 1-based ordinal of the ascending key order.

    Ties count separately (the k-th row, not the k-th distinct value).  Null keys must be
    rejected by the caller.  ``sample_rows`` is the sketch's size, ``fanout`` the quantiles taken
    of an interval that is sketched again.  ``first``: what :func:`count_and_sketch` found below
    and above each ordinal, in any order; it saves a scan.
    """
    dtype = keys_df.schema[key].dataType
    keys = keys_df.select(F.col(key).alias("k"))
    size = min(65535, max(64, sample_rows))
    if total is None:
        total = keys.count()
    for t in ordinals:
        if t < 1 or t > total:
            raise ValueError(f"ordinal {t} outside 1..{total}")
    results: dict[int, Any] = {}
    pending = []
    if ordinals:
        whole = _Piece(None, None, 0, total, sorted(set(ordinals)))
        if first:
            whole.spans, whole.most = _spans(list(zip(*first, strict=True))), 5 * rank_error(SKETCH_SIZE) * total
        pending.append(whole)
    for _ in range(max_levels):
        if not pending:
            return {t: results[t] for t in ordinals}
        done = [p for p in pending if min(p.most, p.count) <= window_rows]
        wide = [p for p in pending if min(p.most, p.count) > window_rows]
        pending = []
        for found in ([_finish(keys, dtype, done)] if done else []) + ([_shrink(keys, dtype, wide, fanout, size)] if wide else []):
            for t, (lo, piece) in found.items():
                if piece is None:
                    results[t] = lo
                else:
                    same = next((p for p in pending if p.base == piece.base), None)
                    if same is None:
                        pending.append(piece)
                    else:  # two ordinals of one interval
                        same.targets = sorted({*same.targets, t})
                        same.spans = _spans([*same.spans, *piece.spans]) if same.spans and piece.spans else []
                        same.most = same.most + piece.most if same.most and piece.most else 0
    raise RuntimeError(f"order statistics not found in {max_levels} scans")


def _dealt(keys: DataFrame, dtype: DataType, pieces: list[_Piece]) -> DataFrame:
    """Rows ``piece, bucket, k`` of the keys that some piece holds."""
    k = F.col("k")
    piece = bucket = None
    for i, p in enumerate(pieces):
        held = p.holds(k, dtype)
        piece = F.when(held, i) if piece is None else piece.when(held, i)
        bucket = F.when(held, p.bucket(k, dtype)) if bucket is None else bucket.when(held, p.bucket(k, dtype))
    return keys.select(piece.alias("piece"), bucket.alias("bucket"), "k").where("piece is not null")


def _finish(keys: DataFrame, dtype: DataType, pieces: list[_Piece]) -> dict[int, tuple]:
    """One scan: keys inside the spans are counted each, what lies between the spans together."""
    inside = F.col("bucket") % 2 == 1
    counts = (_dealt(keys, dtype, pieces)
              .groupBy("piece", "bucket", F.when(inside, F.col("k")).alias("own"))
              .agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")))
    sums = counts.groupBy("piece", "bucket").agg(F.sum("n").alias("all"))  # two for each ordinal at most
    before = sums.withColumn("before", F.sum("all").over(Window.partitionBy("piece").orderBy("bucket")) - F.col("all")).drop("all")
    upto = F.sum("n").over(Window.partitionBy("piece", "bucket").orderBy("own")) + F.col("before")
    targets = F.array(*[F.array(*[F.lit(t - p.base).cast("long") for t in p.targets]) for p in pieces])
    hit = F.exists(targets[F.col("piece")], lambda t: (F.col("upto") >= t) & (F.col("upto") - F.col("n") < t))
    rows = counts.join(F.broadcast(before), ["piece", "bucket"]).withColumn("upto", upto).where(hit).collect()
    return _found(pieces, [(r["piece"], r["lo"], r["hi"], r["n"], r["upto"], None) for r in rows], dtype, 0, 0)


def _shrink(keys: DataFrame, dtype: DataType, pieces: list[_Piece], grid: int, size: int) -> dict[int, tuple]:
    """One scan: rows of each span and between spans, and quantiles of the spans."""
    as_double = image(F.col("k"), dtype)[1]
    g = None
    for i, p in enumerate(pieces):
        own = image(F.col("k"), dtype, p.skip)[0]
        g = F.when(F.col("piece") == i, own) if g is None else g.when(F.col("piece") == i, own)
    share = max(2, min(grid, 200_000 // max(1, sum(len(p.targets) for p in pieces))))
    inside = F.col("bucket") % 2 == 1
    ranks = F.array(*[F.lit(i / share) for i in range(share + 1)])
    sketch = (F.kll_sketch_agg_double if as_double else F.kll_sketch_agg_bigint)(F.when(inside, g), F.lit(size))
    quantile = F.kll_sketch_get_quantile_double if as_double else F.kll_sketch_get_quantile_bigint
    rows = (_dealt(keys, dtype, pieces).groupBy("piece", "bucket")
            .agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi"), sketch.alias("s"))
            .withColumn("q", F.when(inside, quantile("s", ranks))).drop("s").orderBy("piece", "bucket").collect())
    seen, out = [0] * len(pieces), []
    for r in rows:
        seen[r["piece"]] += r["n"]
        out.append((r["piece"], r["lo"], r["hi"], r["n"], seen[r["piece"]], r["q"]))
    return _found(pieces, out, dtype, share, rank_error(size))


def _found(pieces: list[_Piece], rows: list[tuple], dtype: DataType, share: int, error: float) -> dict[int, tuple]:
    """For each target its key, or else the piece to look for it in."""
    out: dict[int, tuple] = {}
    for i, lo, hi, n, upto, quantiles in rows:
        p = pieces[i]
        for t in p.targets:
            local = t - p.base - (upto - n)
            if not 1 <= local <= n:
                continue
            if lo == hi:
                out[t] = (lo, None)
                continue
            piece = _Piece(lo, hi, p.base + upto - n, n, [t], p.skip)
            if quantiles:
                a = max(0, math.floor((local / n - error) * share) - 1)
                b = min(share, math.ceil((local / n + error) * share) + 1)
                piece.spans, piece.most = _spans([(quantiles[a], quantiles[b])]), ((b - a) / share + 2 * error) * n
                if n == p.count and p.spans:
                    piece.most = 0  # the spans took nothing away: too few kinds of keys to narrow any further
            if isinstance(dtype, (StringType, BinaryType)):
                skip = _common(lo, hi)
                if skip >= p.skip + PREFIX:  # their images are all alike
                    piece.skip, piece.spans, piece.most = skip, [], math.inf
            out[t] = (None, piece)
    if len(out) != sum(len(p.targets) for p in pieces):  # counts changed under us
        raise RuntimeError("input changed while computing order statistics")
    return out


def _common(a: str | bytes, b: str | bytes) -> int:
    """Bytes that both begin with."""
    a, b = (x.encode("utf-8", "surrogatepass") if isinstance(x, str) else bytes(x) for x in (a, b))
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
