"""Versioned tables: files an upsert leaves alone, whole commits, refused writers."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sluicemark.plans import snapshots
from sluicemark.plans.snapshots import ConflictError, create_snapshot_table, files_for_keys, latest_version, live_files, read_snapshot, remove_unreferenced, upsert_snapshot


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def names(spark, folder, number=None):
    of = latest_version(spark, folder) if number is None else snapshots.version(spark, folder, number)
    return {r[0] for r in live_files(spark, folder, of).select("file").collect()}


def numbers(spark, start, end, value):
    return spark.range(start, end).select("id", F.lit(value).alias("v"))


def test_only_files_that_can_hold_a_key_are_rewritten(spark, tmp_path):
    folder = str(tmp_path / "t")
    create_snapshot_table(numbers(spark, 0, 10_000, "a"), folder, ["id"], rows_per_file=500)
    before = names(spark, folder)
    done = upsert_snapshot(folder, numbers(spark, 3_100, 3_105, "b").unionByName(numbers(spark, 20_000, 20_003, "c")), rows_per_file=500)
    assert (done["rows_inserted"], done["rows_updated"], done["version"]) == (3, 5, 2) and done["files_rewritten"] <= 2
    after = names(spark, folder)
    assert len(before & after) == len(before) - done["files_rewritten"] == done["files_kept"]
    expected = [(i, "b" if 3_100 <= i < 3_105 else "a") for i in range(10_000)] + [(i, "c") for i in range(20_000, 20_003)]
    assert rows(read_snapshot(spark, folder)) == sorted(expected, key=str)
    assert rows(read_snapshot(spark, folder, 1)) == sorted([(i, "a") for i in range(10_000)], key=str)  # readers of the old version go on


def test_bloom_filters_rule_out_files_whose_range_holds_the_key(spark, tmp_path):
    folder = str(tmp_path / "t")
    even = spark.range(0, 40_000, 2).select(F.col("id"), F.lit("a").alias("v"))
    create_snapshot_table(even, folder, ["id"], rows_per_file=4_000)
    of = latest_version(spark, folder)
    bits = spark.read.schema(snapshots.BITS).parquet(f"{folder}/index/bits").drop("run")
    live = live_files(spark, folder, of)
    absent = spark.createDataFrame([(i,) for i in range(1, 40_000, 4_001) if i % 2], "id long")
    present = spark.createDataFrame([(i,) for i in range(0, 40_000, 2)], "id long")
    assert files_for_keys(live, bits, absent, ["id"]).count() <= 1
    assert files_for_keys(live, bits, present, ["id"]).count() == live.count()
    done = upsert_snapshot(folder, absent.withColumn("v", F.lit("new")))
    assert done["files_rewritten"] <= 1 and done["rows_updated"] == 0


def test_a_write_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "t")
    create_snapshot_table(numbers(spark, 0, 100, "a"), folder, ["id"], rows_per_file=10)
    before = rows(read_snapshot(spark, folder))

    def die(*_):
        raise KeyboardInterrupt

    for step in ("_write_run", "_pruned", "_commit"):
        with monkeypatch.context() as broken:
            broken.setattr(snapshots, step, die)
            with pytest.raises(KeyboardInterrupt):
                upsert_snapshot(folder, numbers(spark, 50, 150, "b"))
        assert rows(read_snapshot(spark, folder)) == before and latest_version(spark, folder).number == 1
    with pytest.raises(Exception, match="broken"):  # a task that fails
        upsert_snapshot(folder, numbers(spark, 0, 9, "b").withColumn("v", F.when(F.col("id") == 8, F.raise_error(F.lit("broken"))).otherwise(F.col("v"))))
    assert rows(read_snapshot(spark, folder)) == before
    assert upsert_snapshot(folder, numbers(spark, 50, 150, "b"))["rows_inserted"] == 50  # and again, now whole


def test_the_second_of_two_writers_is_refused(spark, tmp_path):
    folder = str(tmp_path / "t")
    create_snapshot_table(numbers(spark, 0, 100, "a"), folder, ["id"], rows_per_file=10)
    base = latest_version(spark, folder)
    upsert_snapshot(folder, numbers(spark, 0, 5, "first"), base=base)
    won = rows(read_snapshot(spark, folder))
    with pytest.raises(ConflictError, match="another writer"):
        upsert_snapshot(folder, numbers(spark, 0, 5, "second"), base=base)
    with pytest.raises(ConflictError):
        create_snapshot_table(numbers(spark, 0, 1, "x"), folder, ["id"])
    assert rows(read_snapshot(spark, folder)) == won
    assert not [f for f in (tmp_path / "t" / "versions").iterdir() if f.name.startswith(".") and not f.name.endswith(".crc")]


def test_random_upserts_equal_a_dictionary(spark, tmp_path):
    rng = random.Random(7)
    folder, held, schema = str(tmp_path / "t"), {}, "k1 string, k2 int, v long, nothing string"
    key = lambda: (rng.choice(["", "a", "ab", "é", "zz"]), rng.randint(0, 40))
    held = {key(): -1 for _ in range(120)}
    start = [(*k, v, None) for k, v in held.items()] + [(None, 1, 5, None), ("a", None, 6, None)]
    create_snapshot_table(spark.createDataFrame(start, schema), folder, ["k1", "k2"], rows_per_file=7)
    nulls = [(None, 1, 5, None), ("a", None, 6, None)]
    for step in range(6):
        batch = {key(): step for _ in range(rng.randint(0, 12))}
        extra = [(None, step, step, None)] if step % 2 else []
        source = spark.createDataFrame([(*k, v, None, "more") for k, v in batch.items()] + [(*e, "more") for e in extra], schema + ", other string")
        done = upsert_snapshot(folder, source, rows_per_file=7)
        assert done["rows_updated"] == sum(k in held for k in batch) and done["rows_inserted"] == len(batch) - done["rows_updated"] + len(extra)
        held |= batch
        nulls += extra
        assert rows(read_snapshot(spark, folder)) == sorted([(*k, v, None) for k, v in held.items()] + nulls, key=str)
    kept = rows(read_snapshot(spark, folder))
    assert remove_unreferenced(spark, folder) == 0  # all too young
    assert remove_unreferenced(spark, folder, dt.timedelta(0)) > 0
    assert rows(read_snapshot(spark, folder)) == kept
    with pytest.raises(ValueError, match="rows for key"):
        upsert_snapshot(folder, spark.createDataFrame([("a", 1, 1, None), ("a", 1, 2, None)], schema))
    with pytest.raises(ValueError, match="no table"):
        read_snapshot(spark, f"{folder}x")


def test_large_batches_are_not_broadcast_and_empty_tables_work(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "t")
    create_snapshot_table(numbers(spark, 0, 0, "a"), folder, ["id"])
    assert read_snapshot(spark, folder).count() == 0
    monkeypatch.setattr(snapshots, "BROADCAST_LIMIT_BYTES", 0)
    assert upsert_snapshot(folder, numbers(spark, 0, 50, "b"))["rows_inserted"] == 50
    assert upsert_snapshot(folder, numbers(spark, 25, 75, "c"))["rows_updated"] == 25
    assert upsert_snapshot(folder, numbers(spark, 0, 0, "d"))["files_rewritten"] == 0
    assert read_snapshot(spark, folder).groupBy("v").count().orderBy("v").collect() == [("b", 25), ("c", 50)]


def test_a_whole_version_is_read_without_naming_its_files(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "t")
    create_snapshot_table(numbers(spark, 0, 1_000, "a"), folder, ["id"], rows_per_file=10)
    upsert_snapshot(folder, numbers(spark, 5, 25, "b").unionByName(numbers(spark, 2_000, 2_010, "c")), rows_per_file=10)
    expected = [(i, "b" if 5 <= i < 25 else "a") for i in range(1_000)] + [(i, "c") for i in range(2_000, 2_010)]

    def named(*_):
        raise AssertionError("files were named one by one")

    with monkeypatch.context() as watched:
        watched.setattr(snapshots, "_paths", named)
        assert rows(read_snapshot(spark, folder)) == sorted(expected, key=str)
        assert rows(read_snapshot(spark, folder, 1)) == sorted([(i, "a") for i in range(1_000)], key=str)
    upsert_snapshot(folder, numbers(spark, 0, 1_000, "d"), rows_per_file=1_000)  # now most files are replaced ones
    assert rows(read_snapshot(spark, folder)) == sorted([(i, "d") for i in range(1_000)] + [(i, "c") for i in range(2_000, 2_010)], key=str)
