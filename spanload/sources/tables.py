"""Parquet table access (S1) and the object-id keys used by the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanload.functions.keys import synthetic_hex_key

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """S1 — a full scan; filters and projections applied later reach the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_with_key(spark: SparkSession, sf_dir: str, key: str = "_id") -> DataFrame:
    """events with an object-id key: creation second of ``ts`` + ``event_id``."""
    ev = read_table(spark, sf_dir, "events")
    return ev.withColumn(key, synthetic_hex_key("ts", "event_id"))


def orders_with_key(spark: SparkSession, sf_dir: str, key: str = "_id") -> DataFrame:
    """orders with an object-id key: creation second of ``o_orderdate`` + ``o_orderkey``."""
    od = read_table(spark, sf_dir, "orders")
    return od.withColumn(key, synthetic_hex_key("o_orderdate", "o_orderkey"))
