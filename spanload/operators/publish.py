"""Publishing typed tables.

Tables live in the Spark catalog, in two databases: a staging one and a
final one (W9).  Both are created with an explicit LOCATION under a shared
warehouse root, so nothing lands in a machine-local default folder.

* W4 existence check, W5 skip when the final table exists and no overwrite,
* W6 create from the declared schema, W7 overwrite = drop (absent is fine)
  and create again, so schema changes take effect,
* W8 truncate-load with a column-set check first (``INSERT OVERWRITE``
  would silently fill a missing column with NULL),
* W10 publish staging → final after a complete load, by pointing the final
  table at the files that the load wrote,
* W11 cleanup of staged files whose failure is only logged,
* W12 run-stamped staging folders.

Rows are never written over.  Each load writes a *version*, a folder of its
own under ``<database>/_versions/<table>/``, and only when it is complete the
table is pointed at it: one ``ALTER TABLE … SET LOCATION``, so readers see the
old rows or the new ones.  A run that ends before leaves the old table as it
was.  The staging table is a second name for the same files, not a copy.  A
changed schema needs two catalog calls (drop and create); what is to be
created is written down first, so :func:`finish_pending` can make it good.
The version before the current one is kept for readers that are still at it;
older ones go, and so do those that no table was pointed at, once they are
``ORPHAN_HOURS`` old.
"""

from __future__ import annotations

import datetime as _dt
import json
import logging
import re
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spanload.operators.conform import check_columns

log = logging.getLogger(__name__)

#: Sink types: how a version's files are written and the table over them is declared.
SINKS = {"parquet": {}, "json": {"compression": "gzip"}}
KEPT_VERSIONS = 1  # beside the current one
ORPHAN_HOURS = 24.0
_DB_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


@dataclass
class Warehouse:
    """Two catalog databases under one shared root folder."""

    root: str
    final_db: str = "final"
    staging_db: str = "staging"

    def ensure(self, spark: SparkSession) -> "Warehouse":
        for db in (self.final_db, self.staging_db):
            if not _DB_NAME.match(db):
                raise ValueError(f"invalid database name {db!r}")
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} "
                      f"LOCATION '{self.root.rstrip('/')}/{db}.db'")
        return self

    def name(self, table: str, staging: bool = False) -> str:
        return f"{self.staging_db if staging else self.final_db}.{table}"


def table_exists(spark: SparkSession, full_name: str) -> bool:
    """W4 — other catalog errors surface instead of reading as 'absent'."""
    return spark.catalog.tableExists(full_name)


def _files(spark: SparkSession, path: str):
    """The file system that holds ``path``, and the path for it."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def versions_root(spark: SparkSession, full_name: str) -> str:
    db, table = full_name.split(".")
    return f"{spark.catalog.getDatabase(db).locationUri.rstrip('/')}/_versions/{table}"


def new_version(spark: SparkSession, full_name: str) -> str:
    """A folder for the rows of one load; names sort by time."""
    return f"{versions_root(spark, full_name)}/{run_stamp()}-{time.time_ns() % 10**9:09d}-{uuid.uuid4().hex[:8]}"


def _described(spark: SparkSession, full_name: str, what: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {full_name}").where(F.col("col_name") == what).collect()
    return rows[-1]["data_type"]  # after the columns, one of which may have that name


def location(spark: SparkSession, full_name: str) -> str:
    """The folder that a table is pointed at."""
    return _described(spark, full_name, "Location")


def sink_of(spark: SparkSession, full_name: str) -> str:
    """The type of the files that a table reads."""
    return _described(spark, full_name, "Provider").lower()


def check_sink(sink: str) -> str:
    """S9 — the sink's type; an unknown one fails."""
    if sink not in SINKS:
        raise ValueError(f"unsupported sink type {sink!r}, there are {sorted(SINKS)}")
    return sink


def create_table(spark: SparkSession, full_name: str, schema: StructType, path: str | None = None,
                 sink: str = "parquet") -> None:
    """W6 — create a table, empty or over the files at ``path``; creating twice raises."""
    if path is None:
        path = new_version(spark, full_name)
        fs, folder = _files(spark, path)
        fs.mkdirs(folder)
    spark.catalog.createTable(full_name, path=path, source=check_sink(sink), schema=schema)


def drop_table(spark: SparkSession, full_name: str, files: bool = True) -> None:
    """W7 — drop, with all versions of its rows unless ``files`` is off; an absent table is fine."""
    spark.sql(f"DROP TABLE IF EXISTS {full_name}")
    if files:
        delete_path(spark, versions_root(spark, full_name))


def write_version(spark: SparkSession, df: DataFrame, schema: StructType, path: str, sink: str = "parquet") -> int:
    """Write rows of the schema's columns; returns how many (observed on the write itself)."""
    check_columns(schema, df.schema)
    obs = Observation(f"load_{uuid.uuid4().hex}")
    ordered = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    counted = ordered.observe(obs, F.count(F.lit(1)).alias("rows"))
    counted.write.format(check_sink(sink)).options(**SINKS[sink]).save(path)
    return int(obs.get["rows"])


def point(spark: SparkSession, full_name: str, schema: StructType, path: str, sink: str = "parquet") -> None:
    """W10 — make a table read the files at ``path``: created, moved, or made anew with another
    schema or type."""
    if not table_exists(spark, full_name):
        create_table(spark, full_name, schema, path, sink)
        return
    current = [(f.name, f.dataType) for f in spark.table(full_name).schema.fields]
    if current == [(f.name, f.dataType) for f in schema.fields] and sink_of(spark, full_name) == sink:
        quoted = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {full_name} SET LOCATION '{quoted}'")
        return
    pending = f"{versions_root(spark, full_name)}/_pending"
    spark.createDataFrame([(path, json.dumps(schema.jsonValue()), sink)], _PENDING).coalesce(1).write.mode(
        "overwrite").json(pending)
    drop_table(spark, full_name, files=False)
    create_table(spark, full_name, schema, path, sink)
    delete_path(spark, pending)


_PENDING = "path string, schema string, sink string"


def finish_pending(spark: SparkSession, full_name: str) -> bool:
    """Create the table that a run wrote down and dropped but, being ended, didn't create."""
    pending = f"{versions_root(spark, full_name)}/_pending"
    if not path_exists(spark, f"{pending}/_SUCCESS"):
        return False
    made = False
    if not table_exists(spark, full_name):
        row = spark.read.schema(_PENDING).json(pending).first()
        create_table(spark, full_name, StructType.fromJson(json.loads(row["schema"])), row["path"], row["sink"])
        made = True
    delete_path(spark, pending)
    return made


def remove_old_versions(spark: SparkSession, full_name: str, keep: int = KEPT_VERSIONS,
                        orphan_hours: float = ORPHAN_HOURS) -> list[str]:
    """W11 — versions older than the ``keep`` ones before the current one, and those after it that
    no table was pointed at for ``orphan_hours``; returns what was removed."""
    fs, root = _files(spark, versions_root(spark, full_name))
    if not fs.exists(root):
        return []
    current = location(spark, full_name).rstrip("/").rpartition("/")[2]
    found = {s.getPath().getName(): s for s in fs.listStatus(root) if s.isDirectory() and not s.getPath().getName().startswith("_")}
    before = sorted(n for n in found if n < current)
    old = time.time() * 1000 - orphan_hours * 3_600_000
    gone = before[:-keep] if keep else before
    gone += [n for n in found if n > current and found[n].getModificationTime() < old]
    return [n for n in gone if delete_path(spark, found[n].getPath().toString())]


def truncate_load(spark: SparkSession, df: DataFrame, full_name: str) -> int:
    """W8/A6 — replace an existing table's rows at once; returns the rows written."""
    schema, sink = spark.table(full_name).schema, sink_of(spark, full_name)
    path = new_version(spark, full_name)
    rows = write_version(spark, df, schema, path, sink)
    point(spark, full_name, schema, path, sink)
    return rows


def run_stamp(now: _dt.datetime | None = None) -> str:
    """W12 — ``yyyyMMdd-HHmmss`` stamp for a run's staging folder."""
    return (now or _dt.datetime.now(_dt.timezone.utc)).strftime("%Y%m%d-%H%M%S")


def staged_folder(root: str, table: str, stamp: str) -> str:
    return f"{root.rstrip('/')}/{table}-{stamp}"


def delete_path(spark: SparkSession, path: str) -> bool:
    """W11 — remove staged files on whatever file system holds them; never raises."""
    try:
        fs, folder = _files(spark, path)
        return bool(fs.delete(folder, True))
    except Exception as e:  # noqa: BLE001 — cleanup failure is only logged
        log.error("failed to delete staged files %s: %s", path, e)
        return False


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system holds it."""
    fs, there = _files(spark, path)
    return bool(fs.exists(there))


def publish(spark: SparkSession, typed: DataFrame, schema: StructType, table: str,
            wh: Warehouse, overwrite: bool = False, use_staging: bool = True, sink: str = "parquet") -> dict:
    """Create/overwrite/skip rules, then one write and a change of the table's location.

    Returns ``{"status": "ok"|"skipped", "rows": n}``.
    """
    final = wh.name(table)
    finish_pending(spark, final)
    if table_exists(spark, final) and not overwrite:
        log.info("table %s already exists, skipping", final)
        return {"status": "skipped", "rows": None}
    path = new_version(spark, final)
    rows = write_version(spark, typed, schema, path, sink)
    if use_staging:  # W9 — a name for the complete load, always rebuilt
        staging = wh.name(table, staging=True)
        drop_table(spark, staging)
        create_table(spark, staging, schema, path, sink)
    point(spark, final, schema, path, sink)
    remove_old_versions(spark, final)
    return {"status": "ok", "rows": rows}
