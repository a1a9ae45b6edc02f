from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sluicemark.operators.merge import ACTION, assert_unique_keys, merge_metrics, read_metrics, upsert

BOTH = pytest.mark.parametrize("small", [False, True])


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@BOTH
def test_update_insert_keep(spark, small):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    source = spark.createDataFrame([("B", 2, "x"), ("C", 3, "y")], "V string, ID long, extra string")
    result = upsert(target, source, ["Id"], small, with_action=True)
    assert rows(result) == Counter([(1, "a", "keep"), (2, "B", "update"), (3, "C", "insert")])
    assert result.columns == ["id", "v", ACTION]
    assert upsert(target, source, ["id"], small).schema["id"].dataType == target.schema["id"].dataType


@BOTH
def test_null_keys_never_match(spark, small):
    target = spark.createDataFrame([(None, "t"), (1, "a")], "id int, v string")
    source = spark.createDataFrame([(None, "s"), (1, "b")], "id int, v string")
    assert rows(upsert(target, source, ["id"], small)) == Counter([(None, "t"), (None, "s"), (1, "b")])
    assert read_metrics(merge_metrics(target, source, ["id"])) == (1, 1)


@BOTH
def test_null_values_overwrite(spark, small):
    target = spark.createDataFrame([(1, "a")], "id int, v string")
    source = spark.createDataFrame([(1, None)], "id int, v string")
    assert rows(upsert(target, source, ["id"], small)) == Counter([(1, None)])


@BOTH
def test_every_target_row_of_a_key_is_updated(spark, small):
    target = spark.createDataFrame([(1, "a"), (1, "b")], "id int, v string")
    source = spark.createDataFrame([(1, "c")], "id int, v string")
    assert rows(upsert(target, source, ["id"], small)) == Counter({(1, "c"): 2})
    assert read_metrics(merge_metrics(target, source, ["id"])) == (0, 2)


@BOTH
def test_empty_sides(spark, small):
    some = spark.createDataFrame([(1, "a")], "id int, v string")
    none = some.limit(0)
    assert rows(upsert(none, some, ["id"], small)) == rows(some)
    assert rows(upsert(some, none, ["id"], small)) == rows(some)
    assert read_metrics(merge_metrics(none, some, ["id"])) == (1, 0)
    assert read_metrics(merge_metrics(some, none, ["id"])) == (0, 0)


def test_bad_input(spark):
    target = spark.createDataFrame([(1, "a")], "id int, v string")
    with pytest.raises(ValueError, match="not found"):
        upsert(target, target.drop("v"), ["id"])
    with pytest.raises(ValueError):
        upsert(target, target, [])
    with pytest.raises(ValueError, match="2 rows for key"):
        assert_unique_keys(target.union(target), ["ID"])
    with pytest.raises(ValueError, match="2 rows for key"):
        upsert(target, target.union(target), ["ID"])
    nulls = spark.createDataFrame([(None, "a"), (None, "b")], "id int, v string")
    assert_unique_keys(nulls, ["id"])


def test_metrics_shape(spark):
    pair = spark.createDataFrame([(10, 20)], "rows_inserted long, rows_updated long")
    assert read_metrics(pair) == (10, 20)
    for wrong in (pair.limit(0), pair.union(pair)):
        with pytest.raises(ValueError):
            read_metrics(wrong)


def test_small_batch_leaves_the_target_unshuffled(spark, tmp_path):
    spark.range(1000).selectExpr("id", "id AS v").write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    source = spark.range(10).selectExpr("id", "-id AS v")
    plan = upsert(target, source, ["id"], source_is_small=True)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 1  # distinct matched keys, no more than the batch


@pytest.mark.parametrize("hot", ["null", "5"])
def test_hot_key_of_the_target(spark, tmp_path, hot):
    """A third of the target has no key, and is set aside; or it has one, and adaptive execution divides it."""
    settings_for_small_data = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for name, value in settings_for_small_data.items():
        spark.conf.set(name, value)
    try:
        rows = spark.range(0, 60_000, numPartitions=8).selectExpr(f"if(id % 3 = 0, {hot}, id) AS id", "uuid() AS v")
        rows.write.parquet(str(tmp_path / "t"))
        target = spark.read.parquet(str(tmp_path / "t"))
        source = spark.range(50_000, 70_000).selectExpr("id", "'new' AS v")
        merged = upsert(target, source, ["id"], target_keys_repeat=hot != "null")
        found = merged.collect()
        assert sum(str(r["id"]) in ("None", "5") for r in found) == 20_000 + (1 if hot == "5" else 1)
        assert sum(r["v"] == "new" for r in found) == 20_000
        assert hot == "null" or "skew=true" in merged._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in settings_for_small_data:
            spark.conf.unset(name)


key = st.one_of(st.none(), st.integers(0, 4))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(key, key, st.integers(0, 9)), max_size=12),
    st.lists(st.tuples(key, key, st.integers(10, 19)), max_size=12, unique_by=lambda r: r[:2]),
    st.booleans(),
)
def test_against_brute_force(spark, target, source, small):
    whole = {s[:2]: s[2] for s in source if None not in s[:2]}
    held = {t[:2] for t in target}
    expected = Counter((a, b, whole.get((a, b), v)) for a, b, v in target)
    expected += Counter(s for s in source if None in s[:2] or s[:2] not in held)
    schema = "a int, b int, v int"
    merged = upsert(spark.createDataFrame(target, schema), spark.createDataFrame(source, schema), ["a", "b"], small)
    assert rows(merged) == expected
