import json

import pytest
from spanload.operators import publish
from spanload.operators.conform import SchemaError, schema_from_spec
from spanload.plans import batch, load
from spanload.plans.load_checks import event_docs, fresh_warehouse
from spanload.session import scratch_path
from spanload.sources.specs import discover_specs, spec_from_text
from spanload.sources.tables import read_table
from tests.conftest import SF001

SPEC = [{"name": "id", "type": "STRING"}, {"name": "user_id", "type": "INTEGER"}]


def test_create_twice_raises_and_drop_is_idempotent(spark):
    wh = fresh_warehouse(spark, "t-create")
    name = wh.name("t")
    publish.create_table(spark, name, schema_from_spec(SPEC))
    assert publish.table_exists(spark, name)
    with pytest.raises(Exception):
        publish.create_table(spark, name, schema_from_spec(SPEC))
    publish.drop_table(spark, name)
    publish.drop_table(spark, name)
    assert not publish.table_exists(spark, name)


def test_truncate_load_checks_columns(spark):
    wh = fresh_warehouse(spark, "t-trunc")
    name = wh.name("t")
    publish.create_table(spark, name, schema_from_spec(SPEC))
    df = spark.createDataFrame([("a", 1), ("b", 2)], "id string, user_id bigint")
    assert publish.truncate_load(spark, df, name) == 2
    assert publish.truncate_load(spark, df.limit(1), name) == 1
    assert spark.table(name).count() == 1
    with pytest.raises(SchemaError, match="missing"):
        publish.truncate_load(spark, df.select("id"), name)


def test_skip_overwrite_and_staging(spark):
    wh = fresh_warehouse(spark, "t-flow")
    spec = spec_from_text("x/ev.docs.json", json.dumps(SPEC))
    assert spec.table == "ev_docs" and spec.source == "ev.docs"
    docs = event_docs(spark, SF001)
    opts = load.LoadOptions(on_bad="reject", reject_root=scratch_path(spark, "rejects"), key="_id", chunks=4, method="time")
    r1 = load.load_table(spark, docs, spec, wh, opts)
    assert r1.status == "ok" and r1.rows + r1.rejects == 1000
    r2 = load.load_table(spark, docs, spec, wh, opts)
    assert r2.status == "skipped"
    wide = spec_from_text("x/ev.docs.json", json.dumps(SPEC + [{"name": "note", "type": "STRING"}]))
    r3 = load.load_table(spark, docs, wide, wh, load.LoadOptions(on_bad="reject", reject_root=scratch_path(spark, "rejects"), 
        key="_id", chunks=4, method="count", overwrite=True,
        export_root=scratch_path(spark, "t-exp"), part_limit=20000, keep_export=False))
    assert r3.status == "ok" and r3.parts and r3.parts > 1
    assert spark.table(wh.name("ev_docs")).columns == ["id", "user_id", "note"]
    assert spark.table(wh.name("ev_docs", staging=True)).count() == r3.rows


def test_empty_chunk_fails_the_table(spark):
    wh = fresh_warehouse(spark, "t-empty")
    spec = spec_from_text("ev.json", json.dumps(SPEC))
    from spanload.operators.splits import KeyRanges
    docs = event_docs(spark, SF001)
    ranges = KeyRanges("_id", docs.schema["_id"].dataType, ["0", "1"])
    with pytest.raises(RuntimeError, match="empty ranges"):
        load.load_table(spark, docs, spec, wh, load.LoadOptions(on_bad="reject", reject_root=scratch_path(spark, "rejects"), key="_id", ranges=ranges))


def test_delete_path_never_raises(spark):
    assert publish.delete_path(spark, "/definitely/not/here") is False
    assert publish.run_stamp().count("-") == 1


def test_batch_failure_does_not_stop_others(spark):
    wh = fresh_warehouse(spark, "t-batch")
    ok = spec_from_text("region.json", json.dumps(load.typed_schema_spec(
        read_table(spark, SF001, "region").schema)))
    bad = spec_from_text("nation.json", json.dumps(
        [{"name": "n_nationkey", "type": "INTEGER"}, {"name": "n_name", "type": "INTEGER"}]))
    jobs = [batch.TableJob(ok, lambda s: read_table(s, SF001, "region"),
                           load.LoadOptions(key="r_regionkey", method="count", on_bad="fail")),
            batch.TableJob(bad, lambda s: read_table(s, SF001, "nation"),
                           load.LoadOptions(key="n_nationkey", method="count", on_bad="fail"))]
    res = batch.run_batch(spark, jobs, wh, workers=3)
    status = {r.table: r.status for r in res.results}
    assert status == {"region": "ok", "nation": "failed"}
    assert res.exit_code == 1
    s = res.summary(spark).first()
    assert (s["total"], s["ok"], s["skipped"], s["failed"]) == (2, 1, 0, 1)
    with pytest.raises(ValueError, match="same table"):
        batch.run_batch(spark, jobs + jobs[:1], wh)


def test_discover_specs(spark):
    folder = scratch_path(spark, "t-specs")
    rows = [("a.json", json.dumps(SPEC)), ("b.json", json.dumps(SPEC))]
    for name, text in rows:
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(
            f"{folder}/tmp-{name}")
    # binaryFile lists files; copy the single part file content into <name>
    import glob
    import os
    import shutil
    base = folder.replace("file:", "")
    for name, _ in rows:
        part = glob.glob(f"{base}/tmp-{name}/part-*")[0]
        shutil.copy(part, f"{base}/{name}")
    specs = discover_specs(spark, folder)
    assert [s.table for s in specs] == ["a", "b"]
    with pytest.raises(SchemaError):
        discover_specs(spark, folder + "/missing")
    assert os.path.exists(base)


def test_rejects_are_kept_with_reasons(spark):
    from spanload.plans.load_checks import events_spec
    wh = fresh_warehouse(spark, "t-rejects")
    r = load.load_table(spark, event_docs(spark, SF001), events_spec(), wh, load.LoadOptions(on_bad="reject", 
        key="_id", chunks=4, method="count", export_root=scratch_path(spark, "t-rej")))
    rej = spark.read.json(r.export_path + "/rejects")
    assert rej.count() == r.rejects and r.rows + r.rejects == 1000
    reasons = {x[0] for x in rej.select("reject_reason").distinct().collect()}
    assert "null in repeated field: tags" in reasons and "undecodable" in reasons
    assert rej.where("doc IS NULL").count() == 0


class Ended(Exception):
    """Stands for a run that is killed."""


def _publish(spark, wh, rows, ddl, **opts):
    df = spark.createDataFrame(rows, ddl)
    return publish.publish(spark, df, df.schema, "t", wh, overwrite=True, **opts)


@pytest.mark.parametrize("step", ["write_version", "point", "remove_old_versions"])
def test_a_run_that_ends_between_steps_leaves_a_whole_table(spark, monkeypatch, step):
    wh = fresh_warehouse(spark, f"t-ends-{step}".replace("_", "-"))
    _publish(spark, wh, [("a", 1), ("b", 2)], "id string, n bigint")
    own = getattr(publish, step)

    def ended(*args, **kw):
        if step == "write_version":  # part of the new rows are there
            own(*args, **kw)
        raise Ended

    monkeypatch.setattr(publish, step, ended)
    with pytest.raises(Ended):
        _publish(spark, wh, [("c", 3)], "id string, n bigint")
    monkeypatch.undo()
    want = [("c", 3)] if step == "remove_old_versions" else [("a", 1), ("b", 2)]
    assert sorted(tuple(r) for r in spark.table(wh.name("t")).collect()) == want
    assert _publish(spark, wh, [("d", 4)], "id string, n bigint") == {"status": "ok", "rows": 1}
    assert [tuple(r) for r in spark.table(wh.name("t")).collect()] == [("d", 4)]


def test_a_changed_schema_is_made_good_after_a_run_that_ended(spark, monkeypatch):
    wh = fresh_warehouse(spark, "t-schema")
    _publish(spark, wh, [("a", 1)], "id string, n bigint", use_staging=False)
    own = publish.create_table
    monkeypatch.setattr(publish, "create_table", lambda *a: (_ for _ in ()).throw(Ended()))
    with pytest.raises(Ended):
        _publish(spark, wh, [("b", 2.5)], "id string, x double", use_staging=False)
    monkeypatch.setattr(publish, "create_table", own)
    assert not publish.table_exists(spark, wh.name("t"))
    assert publish.finish_pending(spark, wh.name("t")) and not publish.finish_pending(spark, wh.name("t"))
    assert [tuple(r) for r in spark.table(wh.name("t")).collect()] == [("b", 2.5)]


def test_a_reader_of_the_version_before_still_has_it(spark):
    wh = fresh_warehouse(spark, "t-reader")
    _publish(spark, wh, [("a", 1)], "id string, n bigint")
    reader = spark.read.parquet(publish.location(spark, wh.name("t")))
    before = spark.table(wh.name("t"))
    _publish(spark, wh, [("b", 2)], "id string, n bigint")
    assert [tuple(r) for r in reader.collect()] == [("a", 1)]
    assert [tuple(r) for r in spark.table(wh.name("t")).collect()] == [("b", 2)]
    del before
    for n in range(3):
        _publish(spark, wh, [("c", n)], "id string, n bigint")
    fs, root = publish._files(spark, publish.versions_root(spark, wh.name("t")))
    assert len(list(fs.listStatus(root))) == 1 + publish.KEPT_VERSIONS
    staging = publish.location(spark, wh.name("t", staging=True))
    assert staging == publish.location(spark, wh.name("t"))  # a name, not a copy


def test_versions_that_no_table_took_go_after_their_time(spark, monkeypatch):
    wh = fresh_warehouse(spark, "t-orphans")
    _publish(spark, wh, [("a", 1)], "id string, n bigint")
    spark.range(1).write.parquet(publish.new_version(spark, wh.name("t")))
    assert publish.remove_old_versions(spark, wh.name("t")) == []
    assert len(publish.remove_old_versions(spark, wh.name("t"), orphan_hours=-1)) == 1
    assert [tuple(r) for r in spark.table(wh.name("t")).collect()] == [("a", 1)]


def test_sinks_by_type(spark):
    wh = fresh_warehouse(spark, "t-sinks")
    rows, ddl = [("a", [1, 2], bytearray(b"x")), (None, [], None)], "location string, n array<int>, b binary"
    for sink in ("json", "parquet", "json"):
        assert _publish(spark, wh, rows, ddl, sink=sink) == {"status": "ok", "rows": 2}
        assert publish.sink_of(spark, wh.name("t")) == sink
        assert sorted((tuple(r) for r in spark.table(wh.name("t")).collect()), key=str) == sorted(
            ((a, n, b) for a, n, b in rows), key=str)
    df = spark.createDataFrame(rows[:1], ddl)
    assert publish.truncate_load(spark, df, wh.name("t")) == 1 and spark.table(wh.name("t")).count() == 1
    with pytest.raises(ValueError, match="unsupported sink type"):
        _publish(spark, wh, rows, ddl, sink="tape")
