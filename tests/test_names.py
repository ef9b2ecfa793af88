from pyspark.sql import functions as F

from spanload.functions.names import (normalize_table_name, normalize_table_name_col,
                                      source_table_name)

CASES = {
    "a/video_catalog.sources.json": "video_catalog_sources",
    "9x.json": "t_9x",
    "a--b.json": "a_b",
    ".json": "",
    "Ünï.json": "_n_",
    "config/table/users.json": "users",
}


def test_python_names():
    for path, want in CASES.items():
        assert normalize_table_name(path) == want, path
    assert source_table_name("config/table/video_catalog.sources.json") == "video_catalog.sources"


def test_column_names(spark):
    df = spark.createDataFrame([(p,) for p in CASES], "p string")
    got = {r[0]: r[1] for r in df.select("p", normalize_table_name_col("p")).collect()}
    assert got == CASES
