from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sluicemark.operators import export
from sluicemark.sources.files import read_or_empty
from sluicemark.sources.loading import load_files


def files(folder):
    return sorted(p for p in Path(folder).rglob("part-*"))


def test_limit_zero_none_and_n(spark, tmp_path):
    df = spark.range(50)
    for n, expected in ((0, 50), (None, 50), (7, 7), (80, 50)):
        folder = export.unload(df, str(tmp_path / f"out{n}"), "test_schema.csv_format_tf", n)
        assert folder.endswith("/")
        assert spark.read.csv(folder, header=True).count() == expected


@pytest.mark.parametrize("n", [1, 9, 10, 11, 55, 99, 100, 500])
def test_limit_keeps_exactly_n_rows(spark, tmp_path, n):
    spark.range(0, 100, numPartitions=10).write.parquet(str(tmp_path / "t"))
    limited = export.limit_rows(spark.read.parquet(str(tmp_path / "t")), n)
    assert limited.distinct().count() == min(n, 100)
    assert limited.columns == ["id"]


@pytest.mark.parametrize("n", [1, 37, 200])
def test_limit_of_a_sorted_frame_keeps_the_first_rows(spark, n):
    sorted_ids = spark.range(0, 100, numPartitions=7).orderBy(F.col("id").desc())
    assert sorted(r["id"] for r in export.limit_rows(sorted_ids, n).collect()) == list(range(max(0, 100 - n), 100))


def test_csv_comes_back_as_it_was(spark, tmp_path):
    rows = [(1, 'say "hi", ok'), (2, "one\ntwo"), (3, ""), (4, None), (5, "  spaces  "), (6, '"'), (7, 'back\\slash"'), (8, ",")]
    df = spark.createDataFrame(rows, "id int, t string")
    folder = export.unload(df, str(tmp_path / "x"), "csv")
    rows[2] = (3, None)  # an empty text is written like a null
    assert sorted(map(tuple, read_or_empty(spark, folder, "csv", df.schema).collect())) == rows
    assert sorted(map(tuple, load_files(spark, str(tmp_path), "x", "csv", df.schema).select("id", "t").collect())) == rows


def test_empty_table_unloads(spark, tmp_path):
    export.unload(spark.range(0), str(tmp_path / "none"), "parquet")
    assert spark.read.schema("id long").parquet(str(tmp_path / "none")).count() == 0


def test_write_skips_empty_and_adds_the_suffix_once(spark, tmp_path):
    rows = [("Yum Yum", "cup", 4.0), ("Yum Yum", "cup", 4.0), ("Indomie", "cup", 3.5), ("Indomie", "pack", 15.0), ("Indomie", "pack", 5.0)]
    df = spark.createDataFrame(rows, "brand string, style string, rating double")
    assert export.write_skip_empty(df, str(tmp_path / "a")) is True
    assert export.write_skip_empty(df, str(tmp_path / "b.parquet")) is True
    assert export.write_skip_empty(df.limit(0), str(tmp_path / "c")) is True
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a.parquet", "b.parquet"]
    assert spark.read.parquet(str(tmp_path / "a.parquet")).count() == 5
    assert all(".snappy." in p.name for p in files(tmp_path / "a.parquet") if p.suffix == ".parquet")


@pytest.mark.parametrize("n, expected", [(10_000, 1), (10_001, 2)])
def test_chunks_hold_at_most_ten_thousand_rows(spark, tmp_path, n, expected):
    export.export_chunks(spark.range(0, n, numPartitions=1), str(tmp_path / "x"))
    back = spark.read.parquet(str(tmp_path / "x"))
    sizes = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == n and len(sizes) == expected and max(sizes) <= 10_000


def test_rerun_replaces_only_its_partitions(spark, tmp_path):
    folder = str(tmp_path / "landed")
    day = lambda d: F.lit(dt.date(2024, 1, d))
    one = spark.range(5).select("id", F.lit("scorers").alias("feed"), day(1).alias("run_date"))
    two = spark.range(3).select("id", F.lit("scorers").alias("feed"), day(2).alias("run_date"))
    for rows in (one, two, two.limit(2), two.limit(0)):
        export.land_feeds(rows, folder)
    counts = {str(r["run_date"]): r["count"] for r in spark.read.parquet(folder).groupBy("run_date").count().collect()}
    assert counts == {"2024-01-01": 5, "2024-01-02": 2}


def test_hot_partition_is_split_over_tasks(spark, tmp_path):
    """Adaptive execution cuts a rebalanced partition at the advisory size."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        df = spark.range(0, 200_000, numPartitions=8).select("id", F.rand(1).alias("x"), F.lit("hot").alias("feed"))
        export.replace_partitions(df, str(tmp_path / "hot"), ["feed"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(files(tmp_path / "hot")) > 4
    assert spark.read.parquet(str(tmp_path / "hot")).count() == 200_000
