"""Table specs: schema files, their discovery in a folder, and table names.

Schema files are small configuration; they are read through Spark so they
may live on the cluster's shared storage like everything else.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spanload.functions.names import normalize_table_name, source_table_name
from spanload.operators.conform import SchemaError, schema_from_spec

MAX_SPEC_BYTES = 16 << 20


@dataclass
class TableSpec:
    path: str  # where the schema came from
    source: str  # W14: source table name (not normalised)
    table: str  # W13: published table name (normalised)
    schema: StructType


def spec_from_text(path: str, text: str) -> TableSpec:
    table = normalize_table_name(path)
    if not table:
        raise SchemaError(f"invalid table name for path: {path}")
    return TableSpec(path, source_table_name(path), table, schema_from_spec(text))


def read_spec(spark: SparkSession, path: str) -> TableSpec:
    """S6/F1 — one schema file; a missing or empty file is an error."""
    try:
        rows = (spark.read.text(path, wholetext=True)
                .select(F.length("value").alias("n"), "value").collect())
    except Exception as e:  # noqa: BLE001 — Spark raises AnalysisException subclasses
        raise SchemaError(f"schema file {path} not found: {e}") from e
    if not rows:
        raise SchemaError(f"schema file {path} is empty")
    if rows[0]["n"] > MAX_SPEC_BYTES:
        raise SchemaError(f"schema file {path} is too large")
    return spec_from_text(path, rows[0]["value"])


def discover_specs(spark: SparkSession, folder: str,
                   errors: dict[str, str] | None = None) -> list[TableSpec]:
    """S8 — every ``*.json`` schema file in a folder (sorted); none found is an error.

    Two files whose names normalise to one table name are refused, since
    they would overwrite each other.  With ``errors`` given, a file that is no schema
    is noted there (path → reason) and the others are returned.
    """
    try:
        listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(folder)
        too_big = listed.where(F.col("length") > MAX_SPEC_BYTES).select("path").limit(1).collect()
        if too_big:
            raise SchemaError(f"schema file {too_big[0][0]} is too large")
        files = (listed.select("path", F.col("content").cast("string").alias("text"))
                 .orderBy("path").collect())
    except SchemaError:
        raise
    except Exception as e:  # noqa: BLE001
        raise SchemaError(f"cannot list schema files under {folder}: {e}") from e
    if not files:
        raise SchemaError(f"{folder} holds no schema files")
    specs = []
    for r in files:
        try:
            specs.append(spec_from_text(r["path"], r["text"]))
        except SchemaError as e:
            if errors is None:
                raise
            errors[r["path"]] = str(e)
    seen: dict[str, str] = {}
    for s in specs:
        if s.table in seen:
            raise SchemaError(f"{seen[s.table]} and {s.path} both load table {s.table}")
        seen[s.table] = s.path
    return specs
