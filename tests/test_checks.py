from __future__ import annotations

import pytest

from sluicemark.operators.checks import CheckError, Rule, check_row_count, count_violations, passing_rows


def test_count_against_threshold(spark):
    df = spark.range(3)
    assert check_row_count(df, "t", 2) == 3
    for threshold in (3, 4):
        with pytest.raises(CheckError, match=f"3 rows, needs more than {threshold}"):
            check_row_count(df, "t", threshold)
    with pytest.raises(CheckError):
        check_row_count(df.limit(0), "t")


def violations(df, *rules):
    return {(r["column_name"], r["rule"]): r["violations"] for r in count_violations(df, list(rules)).collect()}


def test_bounds_are_inclusive_and_null_passes(spark):
    df = spark.createDataFrame([(63.9,), (64.0,), (100.0,), (128.0,), (128.1,), (None,)], "n double")
    found = violations(df, Rule("n", required=True, minimum=64, maximum=128))
    assert found == {("n", "required"): 1, ("n", "minimum"): 1, ("n", "maximum"): 1}
    assert passing_rows(df, [Rule("n", minimum=64, maximum=128)]).count() == 4


def test_text_length(spark):
    df = spark.createDataFrame([("x" * n,) for n in (9, 10, 20, 21)], "t string")
    assert violations(df, Rule("t", min_length=10, max_length=20)) == {("t", "min_length"): 1, ("t", "max_length"): 1}


def test_enum_constant_and_formats(spark):
    df = spark.createDataFrame([("Store A", "2024-02-29", "2024-01-01T12:17:00+00:00", "12:13:14"), ("Store B", "2024-02-30", "2024-01-01", "25:00:00")], "s string, d string, t string, h string")
    found = violations(
        df,
        Rule("s", one_of=("Store A", "Store 2"), constant="Store A"),
        Rule("d", text_format="date"),
        Rule("t", text_format="date-time"),
        Rule("h", text_format="time"),
    )
    assert set(found.values()) == {1} and len(found) == 5


def test_empty_table_and_no_rules(spark):
    df = spark.createDataFrame([], "n int")
    assert violations(df, Rule("n", required=True)) == {("n", "required"): 0}
    with pytest.raises(ValueError):
        count_violations(df, [])
