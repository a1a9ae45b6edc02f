"""Streams of several micro-batches, owned versions, refused records, loads that keep history."""

from __future__ import annotations

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicemark.functions.dates import ntz
from sluicemark.operators import checks, merge
from sluicemark.plans import flows
from sluicemark.session import new_database
from sluicemark.sources import records
from sluicemark.sources.database import FULL, INCREMENTAL
from sluicemark.sources.files import CsvFormat
from sluicemark.sources.loading import load_files, load_into_table
from sluicemark.streaming.file_loads import load_new_files

NOW = dt.datetime(2024, 2, 1, 6, 0)
SCHEMA = "id long, changed timestamp_ntz, v string"


def drop(spark, folder, name, rows, age_days=0):
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    before = {e.name for e in os.scandir(folder)} if os.path.isdir(folder) else set()
    df.write.mode("append").parquet(folder)
    for e in os.scandir(folder):
        if e.name not in before and age_days:
            then = time.time() - age_days * 86400
            os.utime(e.path, (then, then))


def published(spark, watermark, tmp_path):
    target = f"{new_database(spark, 'marks')}.t"
    start = spark.createDataFrame([(0, dt.datetime(2024, 1, 1), "old")], SCHEMA)
    start = start.withColumns({"metadata_filename": F.lit("x"), "metadata_ingest_time": ntz("2023-12-31 00:00:00")})
    flows.create_target(start, target)
    return flows.TableConfig(target, str(tmp_path), "drops", ["id"], ["changed"], watermark)


@pytest.mark.parametrize("watermark", ["metadata_ingest_time", "changed"])
def test_every_micro_batch_counts(spark, tmp_path, watermark):
    config = published(spark, watermark, tmp_path)
    for i in (3, 2, 1):  # the newest rows come first
        drop(spark, str(tmp_path / "drops"), i, [(i, dt.datetime(2024, 1, 1 + i), f"v{i}")])
    flows.upsert_new_files(spark, config, str(tmp_path / "history"), NOW, files_per_batch=1)
    assert {r.id: r.v for r in spark.table(config.table).collect()} == {0: "old", 1: "v1", 2: "v2", 3: "v3"}
    drop(spark, str(tmp_path / "drops"), 4, [(4, dt.datetime(2024, 1, 9), "v4"), (5, dt.datetime(2023, 1, 1), "late")])
    flows.upsert_new_files(spark, config, str(tmp_path / "history"), NOW + dt.timedelta(days=1), files_per_batch=1)
    assert {r.id for r in spark.table(config.table).collect()} == ({0, 1, 2, 3, 4} if watermark == "changed" else {0, 1, 2, 3, 4, 5})


def test_a_crash_between_micro_batches_keeps_the_watermark(spark, tmp_path, monkeypatch):
    config = published(spark, "changed", tmp_path)
    for i in (3, 2, 1):
        drop(spark, str(tmp_path / "drops"), i, [(i, dt.datetime(2024, 1, 1 + i), f"v{i}")])
    real, calls = flows.publish, []

    def failing(*args, **kwargs):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("crash")
        return real(*args, **kwargs)

    monkeypatch.setattr(flows, "publish", failing)
    with pytest.raises(Exception, match="crash"):
        flows.upsert_new_files(spark, config, str(tmp_path / "history"), NOW, files_per_batch=1)
    flows.upsert_new_files(spark, config, str(tmp_path / "history"), NOW, files_per_batch=1)
    assert {r.id for r in spark.table(config.table).collect()} == {0, 1, 2, 3}


def test_old_dated_files_are_loaded(spark, tmp_path):
    schema = T.StructType.fromDDL(SCHEMA)
    folder = str(tmp_path / "drops")
    drop(spark, folder, 1, [(1, NOW, "new")])
    load = lambda: load_new_files(spark, str(tmp_path), "drops", "parquet", schema, str(tmp_path / "t"), str(tmp_path / "h"), NOW)
    load()
    drop(spark, folder, 2, [(2, NOW, "old")], age_days=30)
    drop(spark, folder, 3, [(3, NOW, "newer")])
    load()
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3


def test_publish_leaves_other_tables_alone(spark):
    database = new_database(spark, "owned")
    for name in ("orders__v0_backup_of_user", "orders__v1_archive", "orders__vendor", "orders__v1_0123abcd"):
        spark.range(3).write.saveAsTable(f"{database}.{name}")
    for n in range(4):
        flows.publish(spark.range(n + 1), f"{database}.orders", keep=dt.timedelta(0))
    names = {r["tableName"] for r in spark.sql(f"SHOW TABLES IN {database}").collect()}
    assert {"orders__v0_backup_of_user", "orders__v1_archive", "orders__vendor", "orders__v1_0123abcd"} <= names
    assert spark.table(f"{database}.orders").count() == 4
    own = flows._versions(spark, f"{database}.orders")
    assert [n for n, _, _ in own] == [3, 4]  # the version just replaced stays until the next one
    flows.publish(spark.range(9), f"{database}.orders")
    assert len(flows._versions(spark, f"{database}.orders")) == 3  # readers have a day


RECORD = T.StructType([T.StructField("k", T.LongType())])
PAYLOADS = ['[{"k":1},{"k":2}]', '[{"k":3},{"k":', "nonsense", "[]", None, "null", '[{"k":"x"},{"k":4}]', "[null]", '{"k":5}']


def test_refused_payloads_are_counted_and_abort(spark):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(PAYLOADS)], "n int, payload string")
    landed = records.records_from_payload(df, "payload", RECORD, ntz(NOW), ["n"], on_error="continue")
    assert sorted((r.n, r.k) for r in landed.collect()) == [(0, 1), (0, 2), (6, 4)]
    refused = records.refused_records(df, "payload", RECORD, ["n"])
    assert sorted(r.n for r in refused.collect()) == [1, 2, 6, 7, 8]
    with pytest.raises(Exception, match="bad record"):
        records.records_from_payload(df, "payload", RECORD, ntz(NOW)).collect()
    good = df.where("n in (0, 3, 4, 5)")
    assert records.records_from_payload(good, "payload", RECORD, ntz(NOW)).count() == 2


def test_a_cut_off_feed_file_is_an_error(spark, tmp_path):
    (tmp_path / "scorers.json").write_text('[{"k":1},{"k":')
    with pytest.raises(Exception, match="(?i)malformed"):
        flows.land_feed_files(spark, str(tmp_path), str(tmp_path / "out"), {"scorers": RECORD}, NOW)


def test_an_open_quote_is_an_error_where_lines_are_split(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,t\n1,"one\ntwo"\n')
    schema = T.StructType.fromDDL("id int, t string")
    assert load_files(spark, str(tmp_path), "a.csv", "csv", schema).first().t == "one\ntwo"
    with pytest.raises(ValueError, match="left open"):
        load_files(spark, str(tmp_path), "a.csv", "csv", schema, on_error="continue", csv=CsvFormat(multiline=False))
    (tmp_path / "b.csv").write_text("id;t\n1;'a;b'\n2;N/A\n")
    other = CsvFormat(sep=";", quote="'", escape="'", null_value="N/A")
    assert [tuple(r) for r in load_files(spark, str(tmp_path), "b.csv", "csv", schema, csv=other).select("id", "t").collect()] == [(1, "a;b"), (2, None)]


def test_loads_keep_history_count_and_commit_once(spark, tmp_path):
    target = f"{new_database(spark, 'history')}.t"
    schema = flows.with_provenance(T.StructType.fromDDL("id int, t string"))
    spark.createDataFrame([], schema).write.saveAsTable(target)
    (tmp_path / "in").mkdir()
    load = lambda **more: load_into_table(spark, target, str(tmp_path), "in", "csv", scan_time=NOW, **more)
    (tmp_path / "in" / "a 1.csv").write_text("id,t\n1,x\n2,y\n")
    assert load() == {"rows_parsed": 2, "rows_loaded": 2, "errors_seen": 0}
    assert load()["rows_parsed"] == 0
    (tmp_path / "in" / "b.csv").write_text("id,t\n3,z\nbad,w\n")
    with pytest.raises(Exception, match="bad record"):
        load(truncate=True)
    assert spark.table(target).count() == 2
    assert load(on_error="continue") == {"rows_parsed": 2, "rows_loaded": 1, "errors_seen": 1}
    assert load(force=True, on_error="continue")["rows_loaded"] == 3 and spark.table(target).count() == 6
    assert load(truncate=True, on_error="continue")["rows_loaded"] == 3 and spark.table(target).count() == 3
    assert load_into_table(spark, target, str(tmp_path), "none", "csv")["rows_parsed"] == 0


def test_one_failing_table_stops_no_other(spark, tmp_path):
    database = new_database(spark, "status")
    for name in ("a", "b"):
        spark.createDataFrame([], flows.with_provenance(T.StructType.fromDDL("id int"))).write.saveAsTable(f"{database}.{name}")
    spark.range(5).selectExpr("cast(id as int) as id").write.parquet(str(tmp_path / "b"))
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.parquet").write_text("no parquet")
    loads = {f"{database}.{n}": (str(tmp_path), n, "parquet") for n in ("a", "b")}
    rows = {r.table_name: r for r in flows.run_tables(spark, loads, FULL).collect()}
    assert rows["a"].status == "failed" and rows["a"].error and rows["b"].status == "done" and rows["b"].rows_loaded == 5
    assert [r.table_name for r in flows.run_tables(spark, loads, INCREMENTAL).collect()] == ["a"]


def test_times_are_whole(spark):
    values = ["10:00:00", "23:59:59.123", "10:00:00Z", "10:00:00+02:00", "10:00:00xyz", "24:00:00", "1:00:00", "10:00:00.", None]
    df = spark.createDataFrame([(v,) for v in values], "t string")
    assert checks.count_violations(df, [checks.Rule("t", text_format="time")]).first().violations == 4


def test_upsert_shuffles_each_side_once(spark, tmp_path):
    spark.range(1000).selectExpr("id k", "id v").write.parquet(str(tmp_path / "t"))
    spark.range(500, 1500).selectExpr("id k", "-id v").write.parquet(str(tmp_path / "s"))
    target, source = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "s"))
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        merged = merge.upsert(target, source, ["k"], source_is_unique=True)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2
        assert merged.agg(F.sum("v")).first()[0] == sum(range(500)) - sum(range(500, 1500))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)


def test_metrics_refuse_repeated_keys(spark):
    target, source = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(1,), (1,), (2,)], "k int")
    with pytest.raises(ValueError, match="2 rows"):
        merge.merge_metrics(target, source, ["k"])
    for small in (True, False):
        assert tuple(merge.merge_metrics(target, source.distinct(), ["k"], source_is_small=small).first()) == (1, 1)


def test_backfill_removes_days_without_rows(spark, tmp_path):
    day = lambda n: dt.datetime(2024, 1, n, 12)
    folder = str(tmp_path / "out")
    rows = [(1, day(1)), (2, day(2)), (3, day(3))]
    run = lambda r, a, b: flows.backfill_by_day(spark.createDataFrame(r, "id int, ts timestamp_ntz"), "ts", a.date(), b.date(), folder)
    run(rows, day(1), day(3))
    run([rows[2]], day(2), day(3))
    assert sorted(r.id for r in spark.read.parquet(folder).collect()) == [1, 3]
