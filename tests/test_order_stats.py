"""Exact order statistics against a brute-force sort, with forced narrowing."""

from pyspark.sql import functions as F

from spanload.operators.order_stats import order_statistics
from spanload.sources.tables import read_table
from tests.conftest import SF01


def brute(df, key, ordinals):
    ks = sorted(r[0] for r in df.select(key).collect())
    return {o: ks[o - 1] for o in ordinals}


def test_ties_with_narrowing(spark):
    li = read_table(spark, SF01, "lineitem")
    ords = [1, 6000, 12000, 30000, 59999, 60000]
    got = order_statistics(li, "l_orderkey", ords, window_rows=500, fanout=4, sample_rows=64)
    assert got == brute(li, "l_orderkey", ords)


def test_hot_key_holding_a_third(spark):
    li = read_table(spark, SF01, "lineitem").withColumn(
        "k", F.when(F.col("l_linenumber") <= 2, F.lit(7)).otherwise(F.col("l_orderkey")))
    ords = [1, 10000, 20000, 25000, 40000, 59000]
    got = order_statistics(li, "k", ords, window_rows=300, fanout=8, sample_rows=128)
    assert got == brute(li, "k", ords)


def test_string_keys(spark):
    ev = read_table(spark, SF01, "events").withColumn("k", F.concat(F.col("event_type"),
                                                                  F.col("user_id").cast("string")))
    ords = [1, 2, 5000, 9999, 10000]
    got = order_statistics(ev, "k", ords, window_rows=100, fanout=5, sample_rows=50)
    assert got == brute(ev, "k", ords)


def test_timestamp_keys_with_sketched_edges(spark):
    od = read_table(spark, SF01, "orders")
    ords = [1, 777, 7500, 14999, 15000]
    got = order_statistics(od, "o_orderdate", ords, window_rows=400, fanout=6)
    assert got == brute(od, "o_orderdate", ords)
