"""Many tables at once.

Each table is one :func:`~spanload.plans.load.load_table` call.  A driver
thread pool submits the tables' Spark jobs concurrently (at most
``workers`` tables in flight, never more than there are tables); each thread
gets its own FAIR scheduler pool so one big table does not starve the
others.  The data work stays on the executors.  One failing table never
stops the others; the report says which failed and why, and the run ends
non-zero when any failed.
"""

from __future__ import annotations

import logging
import traceback
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, LongType, StringType, StructField,
                               StructType)

from spanload.operators.publish import Warehouse
from spanload.plans.load import LoadOptions, LoadResult, load_table
from spanload.sources.specs import TableSpec

log = logging.getLogger(__name__)

DEFAULT_WORKERS = 3

REPORT_SCHEMA = StructType([
    StructField("table_name", StringType(), False),
    StructField("status", StringType(), False),
    StructField("rows", LongType(), True),
    StructField("rejects", LongType(), True),
    StructField("chunks", LongType(), True),
    StructField("parts", LongType(), True),
    StructField("seconds", DoubleType(), True),
    StructField("error", StringType(), True),
])


@dataclass
class TableJob:
    spec: TableSpec
    source: Callable[[SparkSession], DataFrame]  # opened lazily inside the worker
    options: LoadOptions


@dataclass
class BatchResult:
    results: list[LoadResult]

    @property
    def exit_code(self) -> int:
        return 1 if any(r.status == "failed" for r in self.results) else 0

    def report(self, spark: SparkSession) -> DataFrame:
        """B2 — one row per table (a handful of rows, built on the driver)."""
        rows = [(r.table, r.status, r.rows, r.rejects, r.chunks, r.parts, r.seconds, r.error)
                for r in self.results]
        return spark.createDataFrame(rows, REPORT_SCHEMA)

    def summary(self, spark: SparkSession) -> DataFrame:
        """A7 — total / ok / skipped / failed."""
        rep = self.report(spark)
        return rep.agg(F.count(F.lit(1)).alias("total"),
                       F.sum(F.when(F.col("status") == "ok", 1).otherwise(0)).alias("ok"),
                       F.sum(F.when(F.col("status") == "skipped", 1).otherwise(0)).alias("skipped"),
                       F.sum(F.when(F.col("status") == "failed", 1).otherwise(0)).alias("failed"))


def _run_one(spark: SparkSession, job: TableJob, wh: Warehouse, pool: str) -> LoadResult:
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
    try:
        return load_table(spark, job.source(spark), job.spec, wh, job.options)
    except Exception as e:  # noqa: BLE001 — a failed table is a report row
        log.error("table %s failed: %s", job.spec.table, traceback.format_exc(limit=3))
        return LoadResult(job.spec.table, "failed", error=f"{type(e).__name__}: {e}"[:2000])
    finally:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)


def run_batch(spark: SparkSession, jobs: list[TableJob], wh: Warehouse,
              workers: int = DEFAULT_WORKERS,
              bad_specs: dict[str, str] | None = None) -> BatchResult:
    """B1 — load every table, ``workers`` at a time.

    ``bad_specs`` (path → reason, from ``discover_specs``) become failed rows of the report.
    """
    refused = [LoadResult(path, "failed", error=f"SchemaError: {why}"[:2000])
               for path, why in sorted((bad_specs or {}).items())]
    if not jobs and refused:
        return BatchResult(refused)
    if not jobs:
        raise ValueError("no tables to load")
    names = [j.spec.table for j in jobs]
    dup = {n for n in names if names.count(n) > 1}
    if dup:
        raise ValueError(f"several specs load the same table: {sorted(dup)}")
    wh.ensure(spark)
    n = max(1, min(workers, len(jobs)))
    with ThreadPoolExecutor(max_workers=n) as ex:
        futures = [ex.submit(_run_one, spark, j, wh, f"table-{i % n}")
                   for i, j in enumerate(jobs)]
        results = [f.result() for f in futures]
    return BatchResult(results + refused)
