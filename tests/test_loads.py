"""Loads with a history of files: nothing twice, nothing lost, runs that died are settled."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicemark.plans import loads
from sluicemark.plans.flows import with_provenance
from sluicemark.plans.loads import LOADED, backfill_late_files, load_with_history, record_files, unseen_files
from sluicemark.plans.snapshots import latest_version, live_files, read_snapshot
from sluicemark.session import new_database

T0 = dt.datetime(2024, 1, 1)


def target(spark):
    name = f"{new_database(spark, 'loads')}.t"
    spark.createDataFrame([], with_provenance(spark.range(0).schema)).write.saveAsTable(name)
    return name


def drop(spark, path, *ids):
    spark.createDataFrame([(i,) for i in ids], "id long").coalesce(1).write.mode("append").parquet(path)


def ids(spark, table):
    return sorted(r.id for r in spark.table(table).collect())


def test_files_are_loaded_once(spark, tmp_path):
    table, stage, history = target(spark), str(tmp_path), str(tmp_path / "history")
    assert load_with_history(spark, table, stage, "in", "parquet", history, T0)["files_listed"] == 0
    drop(spark, f"{stage}/in", 1, 2)
    drop(spark, f"{stage}/in", 3)
    assert load_with_history(spark, table, stage, "in", "parquet", history, T0) == {"files_listed": 2, "files_loaded": 2, "rows_parsed": 3, "rows_loaded": 3, "errors_seen": 0}
    drop(spark, f"{stage}/in", 4)
    assert load_with_history(spark, table, stage, "in", "parquet", history, T0, files_per_batch=1)["files_loaded"] == 1
    assert load_with_history(spark, table, stage, "in", "parquet", history, T0)["files_loaded"] == 0
    assert ids(spark, table) == [1, 2, 3, 4]
    spark.sql(f"TRUNCATE TABLE {table}")  # the target is not what is asked
    assert load_with_history(spark, table, stage, "in", "parquet", history, T0)["files_loaded"] == 0


@pytest.mark.parametrize("dies", ["before", "after"])
def test_a_run_that_died_is_settled(spark, tmp_path, monkeypatch, dies):
    table, stage, history = target(spark), str(tmp_path), str(tmp_path / "history")
    drop(spark, f"{stage}/in", 1)
    drop(spark, f"{stage}/in", 2)
    real = loads.load_into_table

    def broken(*args, **kw):
        if dies == "after":
            real(*args, **kw)
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(loads, "load_into_table", broken)
        with pytest.raises(KeyboardInterrupt):
            load_with_history(spark, table, stage, "in", "parquet", history, T0)
    drop(spark, f"{stage}/in", 3)
    assert load_with_history(spark, table, stage, "in", "parquet", history, T0)["files_loaded"] == (1 if dies == "after" else 3)
    assert ids(spark, table) == [1, 2, 3]


def test_a_long_history_is_asked_by_name(spark, tmp_path):
    history = str(tmp_path / "history")
    names = spark.range(100_000).select(F.format_string("drops/day-%05d/part-%d.parquet", F.floor(F.col("id") / 100).cast("int"), "id").alias("file"))
    record_files(spark, history, names, LOADED)
    listed = names.union(spark.createDataFrame([("drops/new.parquet",), ("drops/day-00001/part-7.csv",)], "file string"))
    assert sorted(r.file for r in unseen_files(spark, history, listed).collect()) == ["drops/day-00001/part-7.csv", "drops/new.parquet"]


def test_small_files_of_the_history_are_put_together(spark, tmp_path):
    history = str(tmp_path / "history")
    for i in range(18):
        record_files(spark, history, spark.createDataFrame([(f"f{i:03d}",)], "file string"), LOADED)
    assert live_files(spark, history, latest_version(spark, history)).count() < 16
    assert read_snapshot(spark, history).count() == 18


def test_late_rows_rewrite_exactly_their_days(spark, tmp_path):
    stage, out, home = str(tmp_path), str(tmp_path / "out"), str(tmp_path / "home")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType())])

    def deliver(*rows):
        spark.createDataFrame([(i, dt.datetime(2024, 1, d, 3) if d else None) for i, d in rows], schema).coalesce(1).write.mode("append").parquet(f"{stage}/in")

    def run(work=lambda rows: rows):
        return backfill_late_files(spark, stage, "in", "parquet", schema, "ts", out, home, work)

    def files():
        return {str(f.relative_to(tmp_path)): f.stat().st_mtime_ns for f in (tmp_path / "out").rglob("*.parquet")}

    deliver((1, 1), (2, 2), (3, 3))
    assert run() == [dt.date(2024, 1, d) for d in (1, 2, 3)]
    before = files()
    deliver((4, 2), (5, 7), (6, None))
    with pytest.raises(ZeroDivisionError):  # a run that dies is repeated
        run(lambda rows: 1 / 0)
    assert run() == [dt.date(2024, 1, 2), dt.date(2024, 1, 7)]
    after = files()
    assert {k for k in before if after.get(k) == before[k]} == {k for k in before if "run_date=2024-01-02" not in k}
    assert sorted((r.id, r.run_date.day) for r in spark.read.parquet(out).collect()) == [(1, 1), (2, 2), (3, 3), (4, 2), (5, 7)]
    assert run() == [] and files() == after
