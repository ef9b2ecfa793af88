"""Key-range splits against the golden values of FIXTURES.md §3."""

import pytest
from pyspark.sql import functions as F

from spanload.operators import chunks, order_stats, splits
from spanload.sources.tables import events_with_key, orders_with_key, read_table
from tests.conftest import SF001, SF01


def sizes(df, ranges):
    rows = (splits.with_chunk(df.select(ranges.key), ranges).groupBy("chunk").count()
            .orderBy("chunk").collect())
    return [r["count"] for r in rows]


def test_count_split_sf0001(spark):
    ev = read_table(spark, SF001, "events")
    r = splits.split_count(ev, "event_id", 10)
    assert r.points == [99, 199, 299, 399, 499, 599, 699, 799, 899]
    assert sizes(ev, r) == [99] + [100] * 8 + [101]


def test_count_split_sf001_n4(spark):
    ev = read_table(spark, SF01, "events")
    r = splits.split_count(ev, "event_id", 4)
    assert r.points == [2499, 4999, 7499]
    assert sizes(ev, r) == [2499, 2500, 2500, 2501]


def test_count_split_orders(spark):
    od = read_table(spark, SF01, "orders")
    r = splits.split_count(od, "o_orderkey", 4)
    assert r.points == [3749, 7499, 11249]
    assert sizes(od, r) == [3749, 3750, 3750, 3751]


def test_sample_split_all_rows(spark):
    ev = read_table(spark, SF01, "events")
    assert splits.split_sample(ev, "event_id", 4).points == [2500, 5000, 7500]


def test_sample_split_small_table(spark):
    rg = read_table(spark, SF01, "region")
    r = splits.split_sample(rg, "r_regionkey", 10)
    assert r.points == [1, 2, 3]
    assert sizes(rg, r) == [1, 1, 1, 2]


def test_time_split_events(spark):
    ev = events_with_key(spark, SF01, "_id")
    r = splits.split_time(ev, "_id", 4)
    assert r.points == [s + "0" * 16 for s in ("659be39b", "65a5c6af", "65afa9c3")]
    assert sizes(ev, r) == [2505, 2480, 2510, 2505]


def test_time_split_orders(spark):
    od = orders_with_key(spark, SF01, "_id")
    r = splits.split_time(od, "_id", 10)
    assert sizes(od, r) == [1499, 1502, 1465, 1500, 1476, 1452, 1493, 1585, 1543, 1485]


def test_small_gate_and_single_chunk(spark):
    pages = read_table(spark, SF01, "pages")
    assert splits.split_count(pages, "page_id", 10, small_rows=1000).points == []
    ev = read_table(spark, SF01, "events")
    assert splits.split(ev, "event_id", 1, "count").points == []


def test_chunk_policy():
    assert splits.chunk_policy(0) == 10
    assert splits.chunk_policy(-3) == 10
    assert splits.chunk_policy(25) == 25
    with pytest.raises(ValueError):
        splits.chunk_policy(25, cap=10)
    assert splits.chunk_policy(7) == 7
    assert splits.chunk_policy(50, cap=100) == 50


def test_time_split_rejects_non_object_ids(spark):
    ev = read_table(spark, SF01, "events").withColumn("k", F.col("event_id").cast("string"))
    with pytest.raises(ValueError, match="not object ids"):
        splits.split_time(ev, "k", 4)
    with pytest.raises(ValueError, match="object-id keys"):
        splits.split_time(ev, "event_id", 4)


def test_empty_and_null_keys(spark):
    ev = read_table(spark, SF01, "events")
    with pytest.raises(ValueError, match="no rows to split"):
        splits.split_count(ev.where("event_id < 0"), "event_id", 4)
    with_null = ev.withColumn("event_id", F.when(F.col("event_id") % 2 == 0, F.col("event_id")))
    with pytest.raises(ValueError, match="null key"):
        splits.split_count(with_null, "event_id", 4)


def test_unknown_method_falls_back_to_sampling(spark):
    ev = read_table(spark, SF01, "events")
    assert splits.split(ev, "event_id", 4, "nope").method == "sampling"
    # absent method means "time", which needs object-id keys
    with pytest.raises(ValueError, match="object-id keys"):
        splits.split(ev, "event_id", 4, None)


def test_cover_every_row_once(spark):
    ev = events_with_key(spark, SF01, "_id")
    for method in ("count", "time", "sampling"):
        r = splits.split(ev, "_id", 10, method)
        got = chunks.check_cover(ev, r, expected_rows=10000)
        assert got["rows"] == 10000 and got["distinct_keys"] == 10000


def test_chunk_scan_pushes_range_filter(spark):
    ev = read_table(spark, SF01, "events")
    r = splits.split_count(ev, "event_id", 4)
    plan = chunks.chunk_scan(ev, r, 2)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(event_id,4999)" in plan


def test_empty_chunk_guard(spark):
    ev = read_table(spark, SF01, "events")
    r = splits.KeyRanges("event_id", ev.schema["event_id"].dataType, [100, 100_000, 200_000])
    report = chunks.chunk_report(ev, r)
    assert [x["rows"] for x in report.orderBy("chunk").collect()] == [100, 9900, 0, 0]
    with pytest.raises(Exception, match="empty range"):
        chunks.guard_empty_chunks(report, "error").collect()


def test_empty_input_by_sampling_is_one_open_range(spark):
    ev = read_table(spark, SF01, "events").where("event_id < 0")
    r = splits.split_sample(ev, "event_id", 4)
    assert r.points == [] and r.n_chunks == 1
    with pytest.raises(ValueError, match="creation times"):
        splits.split_time(events_with_key(spark, SF01, "_id").where("event_id < 0"), "_id", 4)


def test_count_split_narrowing_seeded_by_counting_pass(spark):
    li = read_table(spark, SF01, "lineitem")
    r = splits.split_count(li, "l_orderkey", 10, window_rows=500, fanout=8)
    ks = sorted(x[0] for x in li.select("l_orderkey").collect())
    per = len(ks) // 10
    want = []
    for i in range(1, 10):
        if not want or ks[i * per - 1] != want[-1]:
            want.append(ks[i * per - 1])
    assert r.points == want


def test_a_split_takes_two_scans(spark):
    """One scan counts and sketches, one finishes; ties and a key with a third of the rows included."""
    li = read_table(spark, SF01, "lineitem").withColumn(
        "k", F.when(F.col("l_linenumber") <= 2, F.lit(7).cast("long")).otherwise(F.col("l_orderkey")))
    own, scans = order_stats._finish, []
    order_stats._finish = lambda *a: scans.append(1) or own(*a)
    try:
        found = splits.split_count(li, "k", 10)
    finally:
        order_stats._finish = own
    keys = sorted(r[0] for r in li.select("k").collect())
    want = []
    for i in range(1, 10):
        k = keys[i * (len(keys) // 10) - 1]
        if not want or want[-1] != k:
            want.append(k)
    assert found.points == want and len(scans) == 1


@pytest.mark.parametrize("n", [10, 50_000])
def test_assignment_by_a_range_table(spark, n):
    """As the literal expression, for few ranges and for tens of thousands; no nested loop."""
    rows = spark.range(20000).select((F.col("id") * 31 % 100_003).alias("key")).union(
        spark.range(10000).select(F.lit(77_777).cast("long"))).union(spark.createDataFrame([(None,)], "key long"))
    points = [i * (100_000 // n) for i in range(1, n)]
    ranges = splits.KeyRanges("key", rows.schema["key"].dataType, points)
    got = chunks.assign_by_table(rows, "key", ranges.to_df(spark))
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.where("key is null").select("chunk").collect()[0][0] is None
    import bisect
    assert all(r["chunk"] == bisect.bisect_right(points, r["key"]) for r in got.where("key is not null").collect())


def test_samples_do_not_depend_on_the_layout(spark):
    df = spark.range(30000).select((F.col("id") * 7919 % 1_000_003).alias("k"))
    drawn = [sorted(splits.sample_keys(df.repartition(p), "k", 500)) for p in (1, 3, 17)]
    assert drawn[0] == drawn[1] == drawn[2] and len(set(drawn[0])) == 500
    assert sorted(splits.sample_keys(df, "k", 500, seed=7)) != drawn[0]


def test_fingerprints_find_what_differs(spark):
    rows = [(i, "a" if i % 2 else None, float(i)) for i in range(100)]
    a = spark.createDataFrame(rows, "k long, s string, x double")
    ranges = splits.KeyRanges("k", a.schema["k"].dataType, [25, 50, 75])
    assert chunks.reconcile(a, a.repartition(5), ranges).where("not same").count() == 0
    assert chunks.differences(a, a.repartition(5), ranges).count() == 0
    b = spark.createDataFrame([*rows[:10], *rows[11:30], (30, "", 30.0), *rows[31:], rows[60]], a.schema)  # lost, null to empty, doubled
    assert [r["chunk"] for r in chunks.reconcile(a, b, ranges).where("not same").orderBy("chunk").collect()] == [0, 1, 2]
    found = sorted((r["k"], r["s"], r["surplus"]) for r in chunks.differences(a, b, ranges).collect() if r["k"] != 30)
    assert found == [(10, None, -1), (60, None, 1)]
    assert {(r["s"], r["surplus"]) for r in chunks.differences(a, b, ranges).where("k = 30").collect()} == {(None, -1), ("", 1)}
