"""Global numbers, large limits, numbered chunks, and merges with heavy keys."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluicemark.operators.export import export_numbered_chunks, limit_rows
from sluicemark.operators.merge import heavy_keys, upsert
from sluicemark.operators.numbering import numbered


def test_numbers_have_no_gaps_and_follow_the_order(spark):
    df = spark.range(0, 1000, numPartitions=7).withColumn("v", F.col("id") * 2).repartitionByRange(5, F.desc("id")).sortWithinPartitions(F.desc("id"))
    found = sorted(numbered(df, "n").collect(), key=lambda r: r.n)
    assert [r.n for r in found] == list(range(1000)) and [r.id for r in found] == list(range(999, -1, -1)) and found[0].v == 1998
    assert numbered(spark.range(0), "n").count() == 0


@pytest.mark.parametrize("n", [1, 150, 999, 1000, 5000])
def test_large_limits_take_the_first_rows_without_one_task(spark, n):
    df = spark.range(0, 1000, numPartitions=9).repartitionByRange(6, "id").sortWithinPartitions("id")
    limited = limit_rows(df, n, in_one_task=0)
    assert sorted(r.id for r in limited.collect()) == list(range(min(n, 1000)))
    plan = limited._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Limit" not in plan
    assert limit_rows(df, 0).count() == 1000 and limit_rows(df, 10).count() == 10


@pytest.mark.parametrize("file_format", ["parquet", "csv", "json"])
def test_chunks_are_full_named_and_replaced(spark, tmp_path, file_format):
    folder = str(tmp_path / "out")
    for rows, sizes in ((1_050, [100] * 10 + [50]), (300, [100] * 3)):  # a rerun with fewer rows leaves no old chunk
        df = spark.range(0, rows, numPartitions=8).withColumn("v", F.lit("x"))
        assert export_numbered_chunks(df, folder, "items", dt.date(2024, 2, 1), file_format, rows_per_file=100) == len(sizes)
        names = sorted((p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")), key=lambda n: int(n.split("-")[-1].split(".")[0]))
        assert names == [f"items-2024-02-01-chunk-{i}.{file_format}" for i in range(1, len(sizes) + 1)]
        read = [spark.read.format(file_format).option("header", True).load(f"{folder}/{n}") for n in names]
        assert [r.count() for r in read] == sizes and sorted(int(x.id) for r in read for x in r.collect()) == list(range(rows))
    assert export_numbered_chunks(spark.range(0), folder, "none", dt.date(2024, 2, 1)) == 0


def test_heavy_keys_are_found_and_not_shuffled(spark):
    target = spark.range(0, 30_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 1000 == 1, F.lit(None)).otherwise(F.col("id")).alias("k"), F.lit("t").alias("k2"), F.col("id").alias("v")
    )
    source = spark.range(29_000, 31_000).select(F.col("id").cast("int").alias("K"), F.lit("t").alias("K2"), (-F.col("id")).alias("v")).unionByName(
        spark.createDataFrame([(-1, "t", 7), (None, "t", 8), (-2, "t", 9)], "K int, K2 string, v long")
    )
    heavy = heavy_keys(target, ["k", "K2"], tasks=8)
    assert heavy == [spark.sql("SELECT xxhash64(-1L, 't')").first()[0]]
    plain = upsert(target, source, ["k", "k2"], source_is_unique=True, with_action=True)
    split = upsert(target, source, ["k", "k2"], source_is_unique=True, with_action=True, heavy=heavy)
    order = ["k", "v", "_action"]
    assert split.orderBy(order).collect() == plain.orderBy(order).collect()
    spread = split.where("k = -1").groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) == 8 and sum(r["count"] for r in spread) == 10_000
    assert heavy_keys(spark.range(1000), ["id"], tasks=8) == [] and heavy_keys(spark.range(0), ["id"]) == []
    missing = spark.createDataFrame([(5, "t", 1)], "k long, k2 string, v long")
    assert upsert(target, missing, ["k", "k2"], heavy=heavy).where("k = -1").count() == 10_000
