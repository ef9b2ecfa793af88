import pytest

from spanload.operators import splits
from spanload.plans import load
from spanload.session import scratch_path
from spanload.sources import ranges
from spanload.sources.specs import spec_from_text
from spanload.sources.tables import events_with_key, read_table
from tests.conftest import SF01


def _write_text(spark, text):
    path = scratch_path(spark, "t-ranges") + "/r.json"
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return path


def test_roundtrip(spark):
    ev = events_with_key(spark, SF01, "_id")
    made = splits.split_time(ev, "_id", 5)
    path = ranges.write_ranges(spark, made, scratch_path(spark, "t-ranges") + "/ev.json")
    text = spark.read.text(path, wholetext=True).first()[0].strip()
    assert text.startswith('[{"end_id":') and text.endswith('{"start_id":"%s"}]' % made.points[-1])
    back = ranges.read_ranges(spark, path)
    assert back.points == made.points and back.method == "file"


def test_first_start_and_last_end_are_forced_open(spark):
    a, b = "65a000000000000000000000", "65b000000000000000000000"
    path = _write_text(spark, f'[{{"start_id":"zz","end_id":"{a}"}},{{"start_id":"{a}",'
                              f'"end_id":"{b}"}},{{"start_id":"{b}","end_id":"junk"}}]')
    assert ranges.read_ranges(spark, path).points == [a, b]


def test_bad_files(spark):
    a = "65a000000000000000000000"
    with pytest.raises(ValueError, match="invalid end_id at index 0"):
        ranges.read_ranges(spark, _write_text(spark, '[{"end_id":"xyz"},{"start_id":"xyz"}]'))
    with pytest.raises(ValueError, match="no ranges"):
        ranges.read_ranges(spark, _write_text(spark, "[]"))
    with pytest.raises(ValueError, match="starts at"):
        ranges.read_ranges(spark, _write_text(
            spark, f'[{{"end_id":"{a}"}},{{"start_id":"65b000000000000000000000"}}]'))


def test_make_range_file_and_source_types(spark):
    from spanload.sources.formats import SOURCE_TYPES, open_source, raw_json_documents
    ev = events_with_key(spark, SF01, "_id")
    path = scratch_path(spark, "t-ranges") + "/events.json"
    made = ranges.make_range_file(spark, ev, "_id", path, chunks=12, method=3)
    assert made.n_chunks == 12 and ranges.read_ranges(spark, path).points == made.points
    with pytest.raises(ValueError):
        ranges.make_range_file(spark, ev, "_id", path, method=7)
    assert "parquet" in SOURCE_TYPES
    df = open_source(spark, "parquet", f"{SF01}/region.parquet")
    assert df.count() == 5
    with pytest.raises(ValueError, match="unsupported source type"):
        open_source(spark, "no-such-format", "x")
    txt = scratch_path(spark, "t-raw") + "/docs"
    spark.createDataFrame([('{"a":1}',), ('{"b":2}',)], "value string").write.text(txt)
    assert sorted(r["doc"] for r in raw_json_documents(spark, txt).collect()) == [
        '{"a":1}', '{"b":2}']


def test_numeric_keys_round_trip(spark):
    ev = read_table(spark, SF01, "events")
    made = splits.split_count(ev, "event_id", 6)
    path = scratch_path(spark, "ranges-numeric")
    ranges.write_ranges(spark, made, path)
    back = ranges.read_ranges(spark, path, "event_id")
    assert back.points == made.points and back.dtype == made.dtype


def test_many_points_use_the_array_search(spark):
    r = splits.KeyRanges("id", made_type(spark), list(range(10, 20000, 10)), "test")
    got = spark.range(20005).select("id", r.chunk_of().alias("c"))
    assert got.where("c <> least(id div 10, 1999)").isEmpty()


def made_type(spark):
    return spark.range(1).schema["id"].dataType


def test_range_folder(spark, tmp_path):
    spec = spec_from_text("t.json", '[{"name": "n", "type": "INTEGER"}]')
    df = spark.range(2000).withColumnRenamed("id", "n")
    opts = load.LoadOptions(key="n", method="count", range_folder=str(tmp_path))
    assert load.saved_ranges(spark, df, spec, opts) is None  # no file: the load splits
    made = ranges.make_range_file(spark, df, "n", f"{tmp_path}/t.json", chunks=5, method=3)
    assert load.saved_ranges(spark, df, spec, opts).points == made.points
    with pytest.raises(ValueError, match="holds bigint keys"):
        load.saved_ranges(spark, df.select(df.n.cast("string").alias("n")), spec, opts)
