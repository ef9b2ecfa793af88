"""Source and sink choice by type.

The input side is any DataFrame: a document source is read with Spark's own
connectors (a JSON-lines dump, parquet, a JDBC table with partition
predicates, ...).  Unknown types fail loudly instead of guessing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Readers this package knows how to hand documents from.
SOURCE_TYPES = ("parquet", "json", "orc", "csv", "text", "jdbc")


def open_source(spark: SparkSession, kind: str, path: str | None = None,
                options: dict[str, str] | None = None, schema=None) -> DataFrame:
    """Read a source by type; ``json``/``text`` give raw documents to clean."""
    if kind not in SOURCE_TYPES:
        raise ValueError(f"unsupported source type {kind!r}; known: {', '.join(SOURCE_TYPES)}")
    reader = spark.read.format(kind).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def raw_json_documents(spark: SparkSession, path: str) -> DataFrame:
    """A JSON-lines dump as raw documents: one ``doc`` string per line."""
    return spark.read.text(path).withColumnRenamed("value", "doc")
