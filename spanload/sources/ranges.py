"""Range files.

A range file is a JSON array of ``{start_id?, end_id?}`` objects in chunk
order; the first start and the last end are left out (open).  Files are
written and read through Spark so that they can live on the cluster's
shared storage.  Reading validates the file: an empty list, a bad key, a gap
or an overlap between neighbouring ranges, or unordered ranges are refused.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, _parse_datatype_string

from spanload.functions.keys import is_hex_text
from spanload.operators.splits import KeyRanges

# A range file is metadata: refuse anything that is not small.
MAX_RANGES = 100_000

# Method numbers of the offline range tool.
METHOD_CODES = {1: "sampling", 2: "time", 3: "count"}


def write_ranges(spark: SparkSession, ranges: KeyRanges, path: str) -> str:
    """R6 — save a range table as one JSON array (open ends left out)."""
    table = ranges.to_df(spark).select(
        "chunk", F.col("start_id").cast("string").alias("start_id"),
        F.col("end_id").cast("string").alias("end_id"))
    kind = F.lit(None if isinstance(ranges.dtype, StringType) else ranges.dtype.simpleString()).cast("string")
    text = table.agg(F.to_json(F.transform(
        F.sort_array(F.collect_list(F.struct("chunk", "start_id", "end_id"))),
        lambda x: F.struct(x["start_id"].alias("start_id"), x["end_id"].alias("end_id"), kind.alias("type")),
    )).alias("value"))
    text.coalesce(1).write.mode("overwrite").text(path)
    return path


def read_ranges(spark: SparkSession, path: str, key: str = "_id",
                require_hex: bool = True) -> KeyRanges:
    """S7 — load and validate a range file into :class:`KeyRanges`."""
    raw = spark.read.text(path, wholetext=True)
    items = raw.select(F.posexplode(F.from_json(
        "value", "array<struct<start_id:string,end_id:string,type:string>>")).alias("i", "r"))
    rows = (items.select("i", "r.start_id", "r.end_id", "r.type").orderBy("i")
            .limit(MAX_RANGES + 1).collect())
    if not rows:
        raise ValueError(f"range file {path} holds no ranges")
    if len(rows) > MAX_RANGES:
        raise ValueError(f"range file {path} holds more than {MAX_RANGES} ranges")
    kinds = {r["type"] for r in rows}
    if len(kinds) > 1:
        raise ValueError(f"range file {path} mixes key types")
    dtype = StringType()
    if kinds != {None}:  # other keys than text are cast back to their type
        dtype = _parse_datatype_string(kinds.pop())
        require_hex = False
        cast = spark.createDataFrame([(r["i"], r["start_id"], r["end_id"]) for r in rows],
                                     "i int, start_id string, end_id string")
        rows = (cast.select("i", F.col("start_id").try_cast(dtype).alias("start_id"),
                            F.col("end_id").try_cast(dtype).alias("end_id")).orderBy("i").collect())
        if any(r["start_id"] is None for r in rows[1:]) or any(r["end_id"] is None for r in rows[:-1]):
            raise ValueError(f"range file {path} holds keys that are no {dtype.simpleString()}")
    last = len(rows) - 1
    starts: list[Any] = []
    ends: list[Any] = []
    for r in rows:
        i = r["i"]
        if i > 0:
            if require_hex and not is_hex_text(r["start_id"]):
                raise ValueError(f"invalid start_id at index {i}: {r['start_id']!r}")
            starts.append(r["start_id"])
        if i < last:
            if require_hex and not is_hex_text(r["end_id"]):
                raise ValueError(f"invalid end_id at index {i}: {r['end_id']!r}")
            ends.append(r["end_id"])
    for i, (e, s) in enumerate(zip(ends, starts)):
        if e != s:
            raise ValueError(f"range {i} ends at {e!r} but range {i + 1} starts at {s!r}")
    for i in range(1, len(ends)):
        if not ends[i - 1] < ends[i]:
            raise ValueError(f"ranges are not in ascending key order at index {i}")
    return KeyRanges(key, dtype, ends, "file")


def make_range_file(spark: SparkSession, df, key: str, path: str, chunks: int = 10,
                    method: int = 1) -> KeyRanges:
    """R6 — compute ranges offline (1 sampling, 2 time, 3 count) and save them.

    The chunk number is taken as given (no cap), like the offline tool; a
    later load that finds this file uses it instead of splitting again (R5).
    """
    from spanload.operators import splits
    if method not in METHOD_CODES:
        raise ValueError(f"method must be one of {sorted(METHOD_CODES)}")
    ranges = splits.split(df, key, chunks, METHOD_CODES[method], cap=max(chunks, 1))
    write_ranges(spark, ranges, path)
    return ranges
