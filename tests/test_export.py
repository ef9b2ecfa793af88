"""Part assignment against a brute-force running sum; file layout; goldens."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from spanload.operators import export
from spanload.session import scratch_path
from spanload.sources.tables import read_table
from tests.conftest import SF01


def brute_parts(rows, limit):
    """rows: (chunk, key, h, line, bytes) → {(chunk, key, line): part}."""
    out = {}
    for chunk in sorted({r[0] for r in rows}):
        pre = 0
        for r in sorted((r for r in rows if r[0] == chunk), key=lambda r: (r[1], r[2], r[3])):
            out[(r[0], r[1], r[3])] = pre // limit
            pre += r[4]
    return out


def _check(df, limit, **kw):
    parted = export.assign_parts(df, "key", "line", limit, **kw)
    got = {(r["chunk"], r["key"], r["line"]): r["part"]
           for r in parted.select("chunk", "key", "line", "part").collect()}
    rows = [(r["chunk"], r["key"], r["h"], r["line"], r["b"]) for r in df.select(
        "chunk", "key", F.xxhash64("line").alias("h"), "line",
        (F.octet_length("line") + 1).alias("b")).collect()]
    assert got == brute_parts(rows, limit)


def conv_lines(spark):
    cv = read_table(spark, SF01, "conversations")
    return cv.select((F.col("conv_id") * 1000 + F.col("turn")).alias("key"),
                     F.to_json(F.struct("conv_id", "turn", "role", "text")).alias("line"),
                     (F.col("conv_id") % 3).cast("int").alias("chunk"))


def test_golden_first_parts(spark):
    df = conv_lines(spark).withColumn("chunk", F.lit(0))
    rep = export.part_report(export.assign_parts(df, "key", "line", 20000), "key")
    got = [(r["rows"], r["bytes"]) for r in rep.orderBy("part").limit(3).collect()]
    assert got == [(33, 21077), (30, 19499), (37, 19466)]


def test_many_buckets_match_brute_force(spark):
    _check(conv_lines(spark), 7000, bucket_bytes=4000, sample_rows=200)


def test_hot_key_and_searchsorted_path(spark, monkeypatch):
    # a third of the rows share one key; force the array search too
    df = conv_lines(spark).withColumn(
        "key", F.when(F.col("key") % 3 == 0, F.lit(5000)).otherwise(F.col("key")))
    monkeypatch.setattr(export, "TREE_MAX_EDGES", 2)
    _check(df, 9000, bucket_bytes=3000, sample_rows=300)


def test_small_limit_many_files(spark):
    """500 documents, one chunk, 100-byte limit: many parts, every document present."""
    ev = read_table(spark, SF01, "events").where("event_id < 500")
    df = ev.select(F.col("event_id").alias("key"), F.lit(0).alias("chunk"),
                   F.to_json(F.struct("event_id", "event_type")).alias("line"))
    parted = export.assign_parts(df, "key", "line", 100)
    path = export.write_parts(parted, scratch_path(spark, "t-export") + "/x", "key")
    sizes = export.file_sizes(spark, path).collect()
    assert len(sizes) > 1
    back = spark.read.json(path)
    assert back.count() == 500 and back.select("event_id").distinct().count() == 500
    # one file per part, lines in key order inside it
    one = [r for r in sizes if r["part"] == 0][0]
    files = [os.path.join(dp, f) for dp, _, fs in os.walk(path.replace("file:", ""))
             for f in fs if f.endswith(".gz") and "part=0" in dp]
    assert len(files) == 1 and one["file_bytes"] > 0
    with gzip.open(files[0], "rt") as fh:
        keys = [int(x.split('"event_id":')[1].split(",")[0]) for x in fh.read().splitlines()]
    assert keys == sorted(keys)


def test_equal_rows_are_cut_into_parts(spark):
    """1,000 equal rows of 25 bytes and ten keys of 100 equal lines: no part passes its limit."""
    same = spark.range(1000).select(F.lit(7).cast("long").alias("key"), F.lit(0).alias("chunk"),
                                    F.lpad(F.lit("x"), 24, "y").alias("line"))
    rep = export.part_report(export.assign_parts(same, "key", "line", 1000), "key").collect()
    assert sorted(r["part"] for r in rep) == list(range(25)) and {r["bytes"] for r in rep} == {1000}
    ten = spark.range(1000).select((F.col("id") % 10).alias("key"), F.lit(0).alias("chunk"),
                                   F.lpad((F.col("id") % 10).cast("string"), 7, "y").alias("line"))
    rep = export.part_report(export.assign_parts(ten, "key", "line", 200, bucket_bytes=500), "key").collect()
    assert len(rep) == 40 and {r["bytes"] for r in rep} == {200}


def test_timestamp_keys_with_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(export, "TREE_MAX_EDGES", 2)
    ev = read_table(spark, SF01, "events").select(F.col("ts").alias("key"), F.lit(0).alias("chunk"),
                                                  F.col("props").alias("line"))
    rep = export.part_report(export.assign_parts(ev, "key", "line", 3000, bucket_bytes=4000), "key")
    rows = rep.orderBy("part").collect()
    assert sum(r["rows"] for r in rows) == 10000
    assert all(a["max_key"] <= b["min_key"] for a, b in zip(rows, rows[1:]))
    assert max(r["bytes"] for r in rows) < 3000 + 40


def test_limit_must_be_positive(spark):
    with pytest.raises(ValueError):
        export.assign_parts(conv_lines(spark), "key", "line", 0)


def test_shuffle_join_fallback_matches(spark):
    # bucket table never broadcast: the shuffle-join path gives the same parts
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        _check(conv_lines(spark), 5000, bucket_bytes=2000, sample_rows=200)
    finally:
        spark.conf.set(key, before)


def test_a_line_that_a_third_of_the_rows_hold_is_one_row_a_task(spark):
    """The windows read one row for each task's equal lines, and each part keeps its limit."""
    rows = spark.range(30000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("key"), F.lit(0).alias("chunk"),
        F.when(F.col("id") % 3 == 0, F.lit("same line")).otherwise(F.concat(F.lit("l"), F.col("id").cast("string"))).alias("line"))
    parted = export.assign_parts(rows, "key", "line", 2000, bucket_bytes=10_000)
    rep = export.part_report(parted, "key").orderBy("part").collect()
    assert [r["part"] for r in rep] == list(range(len(rep))) and sum(r["rows"] for r in rep) == 30000
    assert all(2000 - 10 <= r["bytes"] < 2000 + 10 for r in rep[:-1])
    assert all(a["max_key"] <= b["min_key"] for a, b in zip(rep, rep[1:]))
    # no window partition holds more than a bucket's share
    runs = parted.where("key = 5").groupBy("part").count()
    assert runs.count() >= 50


def test_sorted_files_hold_one_order(spark):
    """A key with a third of the rows, and equal rows, go to several files, in order inside and across."""
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"), F.lit("x").alias("_place2"))
    path = scratch_path(spark, "t-sorted")
    files = export.write_sorted(df, path, ["k"], partitions=12).orderBy("before").collect()
    assert sum(f["rows"] for f in files) == 9000
    assert all(a["last"]["k"] <= b["first"]["k"] and a["before"] + a["rows"] == b["before"] for a, b in zip(files, files[1:]))
    assert sum(f["first"]["k"] <= 5 <= f["last"]["k"] for f in files) >= 3
    for f in files:
        keys = [r["k"] for r in spark.read.parquet(f"{path}/{f['file']}").collect()]
        assert keys == sorted(keys) and (keys[0], keys[-1]) == (f["first"]["k"], f["last"]["k"])


def test_a_bucket_holds_few_parts(spark, monkeypatch):
    """Each row is compared with the part starts of its bucket: neither one line that a third of the
    rows hold nor a limit far below the bucket size makes them many."""
    seen, own = [], export._bucketed
    monkeypatch.setattr(export, "_bucketed", lambda *a, **k: seen.append(own(*a, **k)) or seen[-1])
    rows = spark.range(30000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("key"), F.lit(0).alias("chunk"),
        F.when(F.col("id") % 3 == 0, F.lit("same line")).otherwise(F.concat(F.lit("l"), F.col("id").cast("string"))).alias("line"))
    rep = export.part_report(export.assign_parts(rows, "key", "line", 1000), "key").collect()
    assert sum(r["rows"] for r in rep) == 30000 and max(r["bytes"] for r in rep) < 1010
    sizes = [r["b"] for r in seen[0].groupBy("chunk", "_b", "_s").agg(F.sum("bytes").alias("b")).collect()]
    assert max(sizes) < 40 * 1000 < sum(sizes)


def test_small_parts_share_writing_tasks(spark):
    cores = spark.sparkContext.defaultParallelism
    assert export.writing_tasks(spark.range(1), 10 << 30, 128 << 10, 4) == max(cores, 320)
    assert export.writing_tasks(spark.range(1), 10 << 30, 1 << 30, 4) == 14


def test_large_parts_are_dealt_to_tasks_in_turn(spark):
    """12 parts of three chunks in 12 tasks: none writes two of them, which a hash would not keep to."""
    rows = spark.range(1200).select((F.col("id") % 3).cast("int").alias("chunk"), F.lit(0).alias("part"),
                                    F.col("id").alias("key"), F.lpad(F.col("id").cast("string"), 9, "0").alias("line"))
    parted = rows.withColumn("part", F.floor(F.col("key") / 300).cast("int"))
    path = export.write_parts(parted, scratch_path(spark, "t-dealt"), "key", tasks=12, chunk_parts=[4, 4, 4])
    files = spark.read.text(path).select(F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).alias("task"),
                                         "chunk", "part", "value")
    got = files.groupBy("task").agg(F.count_distinct("chunk", "part").alias("parts"), F.count("*").alias("rows")).collect()
    assert len(got) == 12 and {(r["parts"], r["rows"]) for r in got} == {(1, 100)}
