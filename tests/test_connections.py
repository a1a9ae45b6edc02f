"""Range planning, pushdown and two-phase appends, against a stand-in for a database."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import EqualNullSafe, EqualTo, GreaterThan, In, IsNotNull, IsNull, LessThanOrEqual, Not, StringStartsWith

from sluicemark.sources.connections import append_connection, clause_of, ranges, scan_connection
from tests.fake_database import Fake, connect, holds

SCHEMA = "id long, day date, name string, price double"


@pytest.fixture()
def base(tmp_path):
    fake = Fake(tmp_path)
    rows = [{"id": i, "day": dt.date(2024, 1, 1) + dt.timedelta(days=i % 40), "name": "abc"[i % 3], "price": i / 2} for i in range(200)]
    rows += [{"id": None, "day": None, "name": None, "price": None}, {"id": -1000, "day": dt.date(1999, 1, 1), "name": "a", "price": float("nan")}, {"id": 10**9, "day": None, "name": "A", "price": 1.0}]
    fake.save("target", rows)
    return fake, rows


def notes(folder):
    return [json.loads(f.read_text()) for f in folder.glob("note-*")]


def scan(spark, fake, **options):
    return scan_connection(spark, connect, "target", SCHEMA, {"folder": str(fake.folder)}, **options)


def test_ranges_take_every_row_once(spark, base):
    fake, rows = base
    for options in ({}, {"split_column": "id", "bounds": (0, 200), "partitions": 7}, {"split_column": "id", "partitions": 5}, {"split_column": "day", "partitions": 4}):
        df = scan(spark, fake, fetch_rows=17, **options)
        found = df.collect()
        assert sorted(map(str, (r.id for r in found))) == sorted(str(r["id"]) for r in rows)
        assert df.rdd.getNumPartitions() == options.get("partitions", 1)
    assert {r.day for r in found} == {r["day"] for r in rows}


@settings(max_examples=60, deadline=None)
@given(st.integers(-50, 50), st.integers(-50, 50), st.integers(1, 12), st.lists(st.one_of(st.none(), st.integers(-80, 80)), max_size=40))
def test_ranges_are_disjoint_and_whole(low, high, parts, values):
    clauses = ranges("id", low, high, parts)
    assert len(clauses) <= parts
    for value in values:
        assert sum(c is None or holds(c[0], {"id": value}, c[1]) for c in clauses) == 1


def test_bounds_that_cannot_split(spark, base):
    assert ranges("id", 3, 3, 4) == [None] and ranges("id", None, None, 4) == [None] and ranges("id", 9, 1, 4) == [None] and ranges(None, 1, 9, 4) == [None]
    with pytest.raises(Exception, match="cannot split by name"):
        scan(spark, base[0], split_column="name", partitions=3).collect()
    base[0].save("target", [])
    assert scan(spark, base[0], split_column="id", partitions=3).count() == 0


def test_clauses():
    schema = T.StructType.fromDDL(SCHEMA)
    cases = [
        (EqualTo(("id",), 3), ('"id" = ?', [3]), True), (GreaterThan(("day",), dt.date(2024, 1, 5)), ('"day" > ?', [dt.date(2024, 1, 5)]), True),
        (In(("id",), (1, 2)), ('"id" IN (?, ?)', [1, 2]), True), (Not(In(("id",), (1, 2))), ('NOT ("id" IN (?, ?))', [1, 2]), True),
        (IsNull(("name",)), ('"name" IS NULL', []), True), (IsNotNull(("price",)), ('"price" IS NOT NULL', []), True),
        (EqualTo(("name",), "a"), ('"name" = ?', ["a"]), False), (EqualNullSafe(("id",), None), ('"id" IS NULL', []), True),
        (Not(EqualTo(("name",), "a")), None, False), (GreaterThan(("name",), "a"), None, False), (LessThanOrEqual(("price",), 2.0), None, False),
        (StringStartsWith(("name",), "a"), None, False), (In(("id",), (1, None)), None, False), (EqualTo(("other",), 3), None, False),
    ]
    for condition, clause, whole in cases:
        assert clause_of(condition, schema) == (clause, whole)
    assert clause_of(EqualTo(("id",), 3), schema, "%s")[0] == ('"id" = %s', [3])


def test_conditions_run_in_the_database_and_give_sparks_result(spark, base):
    fake, rows = base
    plain = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    conditions = [
        "id > 20 AND id <= 90", "id IN (3, 5, 1000000000)", "NOT id IN (3, 5)", "day >= DATE'2024-01-10' AND name = 'a'", "name IS NULL", "price > 10", "id IS NOT NULL AND price <= 3",
        "name > 'a'", "NOT (id > 10)", "id <=> 7", "name LIKE 'a%'", "id = 3 OR name = 'b'",
    ]
    for condition in conditions:
        for options in ({}, {"split_column": "id", "bounds": (0, 200), "partitions": 3}):
            found = scan(spark, fake, **options).where(condition)
            assert sorted(map(str, found.collect())) == sorted(map(str, plain.where(condition).collect())), condition
    asked = [n["statement"] for n in notes(fake.folder)]
    assert any('"id" > ?' in s and '"id" <= ?' in s for s in asked) and any('NOT ("id" IN (?, ?))' in s for s in asked)
    assert not any('"price" >' in s or '"name" >' in s or "LIKE" in s for s in asked)


def test_only_the_schema_columns_are_read(spark, base):
    fake, _ = base
    df = scan_connection(spark, "tests.fake_database:connect", "target", "id long", {"folder": str(fake.folder)})
    assert df.agg(F.count("id")).first()[0] == 202
    assert all(n["statement"] == 'SELECT "id" FROM target' for n in notes(fake.folder))


def test_append_is_whole_or_nothing(spark, base):
    fake, rows = base
    more = spark.range(1000, 1100, numPartitions=5).selectExpr("id", "DATE'2024-05-05' AS day", "'n' AS name", "1.5D AS price")
    append_connection(more, connect, "target", {"folder": str(fake.folder)}, fetch_rows=7)
    assert len(fake.load("target")) == len(rows) + 100 and not list(fake.folder.glob("target_stage*"))
    failing = more.select(F.when(F.col("id") == 1099, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")).alias("id"), "day", "name", "price")
    with pytest.raises(Exception, match="broken"):
        append_connection(failing, connect, "target", {"folder": str(fake.folder)})
    assert len(fake.load("target")) == len(rows) + 100 and not list(fake.folder.glob("target_stage*"))


def test_rows_of_an_attempt_that_was_not_committed_stay_out(base, monkeypatch):
    from sluicemark.sources import connections

    fake, rows = base
    connection = connections.Connection("tests.fake_database:connect", json.dumps({"folder": str(fake.folder)}))
    writer = connections.DatabaseWriter(connection, "target", T.StructType.fromDDL("id long, name string"), {"run": "x"})
    writer.prepare()
    messages = []
    for attempt in (1, 2):  # the first attempt's executor is lost after it has written

        class Context:
            partitionId = staticmethod(lambda: 0)
            taskAttemptId = staticmethod(lambda attempt=attempt: attempt)

        monkeypatch.setattr(connections.TaskContext, "get", lambda: Context)
        messages.append(writer.write(iter([(5000, "x"), (5001, "y")])))
    writer.commit(messages[1:])
    assert [r["id"] for r in fake.load("target")[len(rows):]] == [5000, 5001]


def test_functions_executors_cannot_import_are_refused(spark):
    with pytest.raises(ValueError, match="function of a module"):
        scan_connection(spark, lambda: None, "target", SCHEMA)
