"""Randomised cover checks: any keys, any n → every row in exactly one range."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanload.operators import chunks, splits
from spanload.operators.order_stats import order_statistics
from spanload.sources.tables import events_with_key, read_table
from tests.conftest import SF01

SETTINGS = dict(max_examples=12, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])


@settings(**SETTINGS)
@given(keys=st.lists(st.integers(-50, 50), min_size=1, max_size=300),
       n=st.integers(-2, 14), method=st.sampled_from(["count", "sampling"]))
def test_any_keys_cover_once(spark, keys, n, method):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    r = splits.split(df, "k", n, method, small_rows=1)
    assert 1 <= r.n_chunks <= 10
    assert r.points == sorted(set(r.points))
    got = chunks.check_cover(df, r, expected_rows=len(keys))
    assert got["rows"] == len(keys)


@settings(**SETTINGS)
@given(ords=st.lists(st.integers(1, 300), min_size=1, max_size=6),
       fanout=st.integers(2, 9), window=st.integers(1, 120))
def test_order_statistics_any_settings(spark, ords, fanout, window):
    df = spark.createDataFrame([((i * 37) % 41,) for i in range(300)], "k long")
    want = sorted((i * 37) % 41 for i in range(300))
    got = order_statistics(df, "k", ords, window_rows=window, fanout=fanout, sample_rows=16)
    assert got == {o: want[o - 1] for o in ords}


def test_reference_scenarios(spark):
    """2,000 documents by time and by sampling into 4 chunks; 10 documents, 10 asked → 1."""
    ev = events_with_key(spark, SF01, "_id").where("event_id < 2000")
    for method in ("time", "sampling"):
        r = splits.split(ev, "_id", 4, method)
        assert r.n_chunks == 4
        got = chunks.check_cover(ev, r, expected_rows=2000)
        assert got["distinct_keys"] == 2000
    ten = read_table(spark, SF01, "events").where("event_id < 10").withColumn(
        "_id", F.lpad(F.lower(F.hex("event_id")), 24, "0"))
    for method in ("time", "count"):
        assert splits.split(ten, "_id", 10, method, small_rows=1000).n_chunks == 1
