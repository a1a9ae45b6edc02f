from __future__ import annotations

import pytest

from sluicemark import session


def test_measured_size_counts_rows_texts_and_nested_values(spark):
    df = spark.createDataFrame([(1, "abc", [1, 2]), (2, None, None), (3, "\u00e4", [])], "i int, s string, a array<int>")
    lengths = 3 + 2 + len('{"a":[1,2]}') + len("{}") + len('{"a":[]}')
    assert session.measured_bytes(df) == 3 * 3 * 16 + lengths
    assert session.measured_bytes(df.limit(0)) == 0
    staged, size = session.staged_with_size(df)
    assert size == session.measured_bytes(df) and staged.count() == 3
    assert session.fits_broadcast(df, size) and not session.fits_broadcast(df, size - 1)


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert session.shared_dir(spark) == configured.rstrip("/")
    assert session.new_folder(spark, "x") != session.new_folder(spark, "x")


def test_names_resolve_ignoring_case(spark):
    df = spark.range(1).selectExpr("id AS OrderKey")
    assert session.resolve(df, ["ORDERKEY"]) == ["OrderKey"]
    with pytest.raises(ValueError, match="not found"):
        session.resolve(df, ["other"])
