"""Helpers that the operators share: staged tables and bounded Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanload.session import scratch_path
from spanload.sources.tables import read_table

__all__ = ["read_table", "scratch_path", "stage", "small_batches", "batches_of", "ascii_lower", "words_of"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a re-read.  The files stay until the
    folder named by ``spark.checkpoint.dir`` is cleared, because the result is lazy.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1024) -> None:
    """At most ``rows`` rows in an Arrow batch, so that long texts don't fill a worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, str(rows))


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """As :func:`small_batches`, for the jobs that run inside; the session's setting comes back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, "10000")
    small_batches(spark, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def ascii_lower(col):
    """A-Z lower-cased, every other character left as it is."""
    return F.translate(col, UPPER, LOWER)


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text, A-Z lower-cased, as UTF-8.

    ``bytes.lower`` and ``bytes.split`` know ASCII only, which is exactly this rule.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []
