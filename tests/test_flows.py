from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicemark.functions.dates import ntz
from sluicemark.plans import flows
from sluicemark.session import new_database
from sluicemark.sources import files
from sluicemark.sources.records import inline_rows, records_from_files, records_from_payload
from sluicemark.streaming.file_loads import BATCH, load_new_files, read_loaded, truncate_loaded

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def target(spark, rows, name="t", **kw):
    table = f"{new_database(spark, 'flow')}.{name}"
    start = spark.createDataFrame(rows, "id int, v string").withColumns(
        {"metadata_filename": F.lit("first"), "metadata_ingest_time": ntz(T0)}
    )
    flows.create_target(start, table, ["id"], **kw)
    return table


def drop(spark, path, rows):
    spark.createDataFrame(rows, "ID int, V string").coalesce(1).write.mode("append").parquet(path)


def content(spark, table):
    return sorted(tuple(r)[:2] for r in spark.table(table).collect())


@pytest.mark.parametrize("buckets", [None, 4])
def test_upsert_table_publishes_a_new_version(spark, tmp_path, buckets):
    table = target(spark, [(1, "a"), (2, "b")], buckets=buckets)
    drop(spark, str(tmp_path / "in"), [(2, "x"), (2, "y"), (3, "z")])
    config = flows.TableConfig(table, str(tmp_path), "in", ["id"], ["v"], "metadata_ingest_time")
    before = spark.table(table)
    assert flows.upsert_table(spark, config, T1, buckets) == (1, 1)
    assert content(spark, table) == [(1, "a"), (2, "y"), (3, "z")]
    assert before.count() == 2  # readers of the old version are not disturbed
    # the same scan time again: nothing is above the watermark
    assert flows.upsert_table(spark, config, T1, buckets) == (0, 0)
    assert len(flows._versions(spark, table)) == 3  # old versions stay a day


def test_bucketed_target_is_not_shuffled_by_a_large_batch(spark, tmp_path):
    table = target(spark, [(i, "a") for i in range(100)], buckets=4)
    drop(spark, str(tmp_path / "in"), [(i, "b") for i in range(50, 150)])
    config = flows.TableConfig(table, str(tmp_path), "in", ["id"], ["v"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        merged = flows.upsert_files(spark, spark.table(table), config, T1, broadcast_limit=0)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert merged.count() == 150
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1  # the batch; never the target


def test_frame_upsert_refuses_repeated_keys(spark):
    table = target(spark, [(1, "a")])
    twice = spark.table(table).union(spark.table(table))
    with pytest.raises(ValueError, match="rows for key"):
        flows.upsert_frame_into_table(twice, table, ["id"])
    assert flows.upsert_frame_into_table(spark.table(table).withColumn("v", F.lit("n")), table, ["id"]) == (0, 1)
    assert content(spark, table) == [(1, "n")]


def test_many_tables(spark, tmp_path):
    configs = []
    for name in ("a", "b", "c"):
        drop(spark, str(tmp_path / name), [(1, name), (5, name)])
        configs.append(flows.TableConfig(target(spark, [(1, "old")], name), str(tmp_path), name, ["id"], ["v"]))
    found = sorted(tuple(r) for r in flows.upsert_tables(spark, configs, T1).collect())
    assert found == [("a", "done", None, 1, 1), ("b", "done", None, 1, 1), ("c", "done", None, 1, 1)]


def test_partition_upsert_touches_only_its_partitions(spark, tmp_path):
    folder = str(tmp_path / "p")
    rows = [(d, i, "old") for d in ("a", "b") for i in range(3)]
    spark.createDataFrame(rows, "d string, id int, v string").write.partitionBy("d").parquet(folder)
    untouched = {p.name for p in (tmp_path / "p" / "d=a").iterdir()}
    source = spark.createDataFrame([("b", 1, "new"), ("b", 9, "new"), ("c", 1, "new")], "d string, id int, v string")
    flows.upsert_partitions(spark.read.parquet(folder), source, ["d", "id"], ["d"], folder)
    found = sorted((r["d"], r["id"], r["v"]) for r in spark.read.parquet(folder).collect())
    assert found == [("a", 0, "old"), ("a", 1, "old"), ("a", 2, "old"), ("b", 0, "old"), ("b", 1, "new"), ("b", 2, "old"), ("b", 9, "new"), ("c", 1, "new")]
    assert {p.name for p in (tmp_path / "p" / "d=a").iterdir()} == untouched
    with pytest.raises(ValueError, match="part of the key"):
        flows.upsert_partitions(spark.read.parquet(folder), source, ["id"], ["d"], folder)


def test_partitions_are_pruned_by_literals(spark, tmp_path):
    folder = str(tmp_path / "p")
    spark.range(20).selectExpr("id % 5 AS d", "date'2024-01-01' AS run", "id").write.partitionBy("d", "run").parquet(folder)
    source = spark.sql("SELECT 3L AS d, date'2024-01-01' AS run")
    held = flows._only_partitions(spark.read.parquet(folder), source, ["d", "run"])
    assert sorted(r["id"] for r in held.collect()) == [3, 8, 13, 18]
    scan = next(line for line in held._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line)
    assert "PartitionFilters: []" not in scan


def test_key_buckets_rewrite_a_share_of_the_table(spark, tmp_path):
    folder, keys = str(tmp_path / "k"), ["id"]
    start = spark.range(100).select("id", F.lit("old").alias("v"))
    flows.with_key_bucket(start, keys, 32).write.partitionBy(flows.KEY_BUCKET).parquet(folder)
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "k").iterdir() if p.is_dir()}
    source = spark.createDataFrame([(7, "new"), (500, "new")], "id int, v string")
    flows.upsert_key_buckets(spark.read.parquet(folder), source, keys, 32, folder)
    rows = {r["id"]: r["v"] for r in spark.read.parquet(folder).collect()}
    assert len(rows) == 101 and {k for k, v in rows.items() if v == "new"} == {7, 500}
    after = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "k").iterdir() if p.is_dir()}
    assert sum(after[n] != t for n, t in before.items()) <= 2


def test_files_load_once_until_truncated(spark, tmp_path):
    source, table, history = (str(tmp_path / n) for n in ("in", "table", "history"))
    schema = T.StructType().add("id", T.IntegerType()).add("v", T.StringType())
    run = lambda: load_new_files(spark, str(tmp_path), "in", "parquet", schema, table, history, T0)
    count = lambda: read_loaded(spark, table, schema).count()
    drop(spark, source, [(1, "a")])
    run()
    run()
    assert count() == 1
    drop(spark, source, [(2, "b"), (3, "c")])
    run()
    assert count() == 3 and spark.read.parquet(table).select(BATCH).distinct().count() == 2
    assert read_loaded(spark, table, schema).columns == ["id", "v", "metadata_filename", "metadata_ingest_time"]
    load_new_files(spark, str(tmp_path), "in", "parquet", schema, table, history, T0, force=True)
    assert count() == 6
    run()
    assert count() == 6
    truncate_loaded(spark, table, history)
    run()
    assert count() == 3


def test_csv_stream_may_start_before_its_first_file(spark, tmp_path):
    (tmp_path / "in").mkdir()
    schema = T.StructType().add("id", T.IntegerType()).add("v", T.StringType())
    table = str(tmp_path / "table")
    run = lambda: load_new_files(spark, str(tmp_path), "in", "csv", schema, table, str(tmp_path / "h"), T0)
    run()
    (tmp_path / "in" / "a.csv").write_text("v,id\nx,1\n")
    run()
    assert [tuple(r)[:2] for r in read_loaded(spark, table, schema).collect()] == [(1, "x")]


def test_a_batch_repeated_after_a_crash_leaves_its_rows_once(spark, tmp_path):
    table, history = tmp_path / "table", tmp_path / "history"
    schema = T.StructType().add("id", T.IntegerType()).add("v", T.StringType())
    drop(spark, str(tmp_path / "in"), [(1, "a"), (2, "b")])
    run = lambda: load_new_files(spark, str(tmp_path), "in", "parquet", schema, str(table), str(history), T0)
    run()
    for commit in (history / "commits").iterdir():  # as if the run had ended before its commit
        commit.unlink()
    run()
    assert spark.read.parquet(str(table)).count() == 2


def test_a_failed_upsert_leaves_the_table_and_can_be_repeated(spark, tmp_path):
    table = target(spark, [(1, "a")])
    (tmp_path / "in").mkdir()
    bad = tmp_path / "in" / "a.csv"
    bad.write_text("id,v\n2,b\noops,c\n")
    config = flows.TableConfig(table, str(tmp_path), "in", ["id"], ["v"], file_format="csv")
    with pytest.raises(Exception, match="bad record"):
        flows.upsert_table(spark, config, T1)
    with pytest.raises(Exception, match="lost on the way"):
        flows.publish(spark.table(table).withColumn("v", F.raise_error(F.lit("lost on the way")).cast("string")), table)
    assert content(spark, table) == [(1, "a")]
    bad.write_text("id,v\n2,b\n")
    assert flows.upsert_table(spark, config, T1) == (1, 0)
    assert content(spark, table) == [(1, "a"), (2, "b")]


@pytest.mark.parametrize("kind, name, text", [("csv", "a.csv", "V,ID\nx,1\ny,bad\n"), ("json", "a.json", '{"V": "x", "ID": 1}\n{"ID": "bad"}\n')])
def test_text_files_stream_by_name(spark, tmp_path, kind, name, text):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / name).write_text(text)
    schema = T.StructType().add("id", T.IntegerType()).add("v", T.StringType())
    table = str(tmp_path / "table")
    run = lambda: load_new_files(spark, str(tmp_path), "in", kind, schema, table, str(tmp_path / "h"), T0, on_error="continue")
    run()
    run()
    assert [tuple(r) for r in read_loaded(spark, table, schema).collect()] == [(1, "x", f"in/{name}", T0)]


def test_streamed_upsert(spark, tmp_path):
    table, source = target(spark, [(1, "a")]), str(tmp_path / "in")
    config = flows.TableConfig(table, str(tmp_path), "in", ["id"], ["v"])
    run = lambda: flows.upsert_new_files(spark, config, str(tmp_path / "history"), T1)
    drop(spark, source, [(1, "b"), (2, "c")])
    run()
    run()
    drop(spark, source, [(2, "d")])
    run()
    assert content(spark, table) == [(1, "b"), (2, "d")]


def test_build_without_loading(spark, tmp_path):
    drop(spark, str(tmp_path / "in"), [(1, "a")])
    table = f"{new_database(spark, 'build')}.t"
    flows.build_then_load(spark, table, str(tmp_path), "in", "parquet", load_table_afterwards=False)
    assert spark.table(table).count() == 0
    assert spark.table(table).columns == ["ID", "V", "metadata_filename", "metadata_ingest_time"]
    flows.build_then_load(spark, table, str(tmp_path), "in", "parquet")
    assert spark.table(table).count() == 1


def test_backfill_picks_up_late_rows_and_leaves_other_days(spark, tmp_path):
    folder = str(tmp_path / "days")
    rows = [(i, dt.datetime(2024, 1, 1 + i % 3, 5)) for i in range(9)]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz")
    day = lambda d: dt.date(2024, 1, d)
    flows.backfill_by_day(df, "ts", day(1), day(3), folder)
    late = df.union(spark.createDataFrame([(99, dt.datetime(2024, 1, 2, 1))], df.schema))
    flows.backfill_by_day(late, "ts", day(2), day(2), folder)
    found = {str(r["run_date"]): r["count"] for r in spark.read.parquet(folder).groupBy("run_date").count().collect()}
    assert found == {"2024-01-01": 3, "2024-01-02": 4, "2024-01-03": 3}


def test_backfill_bounds():
    assert flows.backfill_bounds(dt.date(2024, 3, 1)) == (dt.date(2024, 2, 29), dt.date(2024, 2, 29))
    assert flows.backfill_bounds(dt.date(2024, 3, 1), dt.date(2024, 2, 1)) == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))


def test_day_slices_count_empty_days_and_take_another_name(spark):
    rows = [(dt.datetime(2024, 2, 29, 3),), (dt.datetime(2024, 2, 29, 4),), (dt.datetime(2024, 3, 2),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    found = flows.day_slices({"t": (df, "ts")}, {"t": dt.date(2024, 3, 2)}, dataset="other").collect()
    assert [tuple(r) for r in sorted(found)] == [("other", "20240229", "20240229", 2), ("other", "20240301", "20240301", 0)]


def test_runs_and_records(spark, tmp_path):
    assert flows.tables_of_run("Full Backfill", ["a", "b"]) == ("backfill", ["a", "b"])
    assert flows.tables_of_run("Incremental", ["a", "b"]) == ("incremental", ["a"])
    assert len(flows.FEEDS) == 10
    record = T.StructType().add("k", T.IntegerType())
    payloads = spark.createDataFrame([(1, '[{"k": 1}, {"k": 2}]'), (2, "[]"), (3, None)], "id int, p string")
    assert [tuple(r) for r in records_from_payload(payloads, "p", record, ntz(T0), ["id"]).collect()] == [(1, 1, T0), (1, 2, T0)]
    (tmp_path / "r.json").write_text('[{"k": 1},\n {"k": 5}]')
    assert [tuple(r) for r in records_from_files(spark, str(tmp_path / "r.json"), record, ntz(T0)).collect()] == [(1, T0), (5, T0)]
    rows = inline_rows(spark, [(1, 100), (2, 200)], "id long, value long", T1).collect()
    assert [tuple(r) for r in rows] == [(1, 100, T1), (2, 200, T1)]


def test_feed_files_land_at_their_path(spark, tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "scorers.json").write_text('[{"k": 1}, {"k": 2}]')
    (tmp_path / "src" / "injuries.json").write_text("[]")
    record = T.StructType().add("k", T.IntegerType())
    for _ in range(2):
        flows.land_feed_files(spark, str(tmp_path / "src"), str(tmp_path), {f: record for f in flows.FEEDS}, T1)
    landed = tmp_path / "rest_api_scrapes"
    assert [p.name for p in landed.iterdir()] == ["scorers"]
    rows = spark.read.parquet(str(landed / "scorers" / "scorers-2024-01-02.parquet")).collect()
    assert sorted(tuple(r) for r in rows) == [(1, T1), (2, T1)]


def test_like_keeps_an_existing_table(spark):
    database = new_database(spark, "like")
    spark.range(3).write.saveAsTable(f"{database}.a")
    files.create_table_like(spark, f"{database}.a", f"{database}.b")
    spark.sql(f"INSERT INTO {database}.b VALUES (7)")
    files.create_table_like(spark, f"{database}.a", f"{database}.b")
    assert spark.table(f"{database}.b").count() == 1


def test_streamed_drops_take_more_files_as_the_table_grows(spark, monkeypatch):
    """A file of the stream is one task's work, so a drop of a large table is many files; its rows are the same."""
    from sluicemark.queries import merge_queries

    assert [merge_queries.files_per_drop(n, drops=3) for n in (0, 60_000, 3_000_000, 3_000_001, 216_000_000)] == [1, 1, 1, 2, 72]
    run = lambda: sorted(map(tuple, merge_queries.upsert_streamed(spark, "/root/testdata/sf0.001").collect()))
    expected, seen, through = run(), [], flows.upsert_new_files

    def counted(own, config, *args, **kw):
        seen.append((own.read.parquet(f"{config.stage}/{config.prefix}").select("_metadata.file_path").distinct().count(), kw["files_per_batch"]))
        through(own, config, *args, **kw)

    monkeypatch.setattr(merge_queries, "files_per_drop", lambda rows, drops: 4)
    monkeypatch.setattr(flows, "upsert_new_files", counted)
    assert run() == expected and seen == [(12, 4), (12, 4)]
