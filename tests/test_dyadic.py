"""Dyadic cells against plain ranges, and joins over long intervals."""

from __future__ import annotations

import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicemark.functions.dyadic import LEAST, MOST, cells_of_point, cells_of_range, on_axis
from sluicemark.operators.intervals import long_interval_join


def test_cells_make_up_the_range_and_are_few(spark):
    rng = random.Random(1)
    bounds = [(a, a + rng.choice([-3, 0, 1, 5, 100, 10**6, 10**12])) for a in (rng.choice([0, 1, -7, rng.randint(-(10**9), 10**9)]) for _ in range(300))]
    bounds += [(LEAST, MOST), (None, 3), (3, None), (-1, 0)]
    rows = spark.createDataFrame(bounds, "a long, b long").select("a", "b", cells_of_range(F.col("a"), F.col("b")).alias("cells")).collect()
    for row in rows:
        held = sorted((c.cell << c.level, ((c.cell + 1) << c.level) - 1) for c in row.cells)
        if row.a is None or row.b is None or row.a > row.b:
            assert held == []
            continue
        assert held[0][0] == row.a and held[-1][1] == row.b and all(x[1] + 1 == y[0] for x, y in zip(held, held[1:]))
        n = row.b - row.a + 1
        assert len(held) <= max(1, 2 * math.log2(n))


def test_a_point_is_in_one_cell_of_a_range_that_holds_it(spark):
    ranges = spark.createDataFrame([(i, i * 3 - 50, i * 3 - 50 + i * i) for i in range(40)], "r long, a long, b long")
    points = spark.range(-60, 200).toDF("p")
    cells = ranges.select("r", "a", "b", F.inline(cells_of_range(F.col("a"), F.col("b"))))
    levels = sorted(x[0] for x in cells.select("level").distinct().collect())
    asked = points.select("p", F.inline(cells_of_point(F.col("p"), levels)))
    found = sorted(tuple(x) for x in asked.join(cells, ["level", "cell"]).select("p", "r").collect())
    assert found == sorted((p, i) for p in range(-60, 200) for i in range(40) if i * 3 - 50 <= p <= i * 3 - 50 + i * i)
    assert spark.createDataFrame([(None,)], "p long").select(F.inline(cells_of_point(F.col("p"), [0, 1]))).count() == 0


@pytest.mark.parametrize(
    "kind, values",
    [
        ("long", [-(2**63), -5, 0, 7, 2**63 - 1]), ("int", [-3, 0, 3]), ("string", ["", "A", "a", "ab", "abcdefgh", "abcdefgi", "b", "é", "中"]), ("boolean", [False, True]),
        ("date", [dt.date(1900, 1, 1), dt.date(2024, 2, 29), dt.date(2024, 3, 1)]), ("double", [-math.inf, -2.5, -0.0, 0.3, 1e30, math.inf, math.nan]),
        ("timestamp_ntz", [dt.datetime(1960, 1, 1, 3), dt.datetime(2024, 1, 1, 5, 6, 7, 8), dt.datetime(2024, 1, 1, 5, 6, 8)]), ("timestamp", [dt.datetime(2024, 1, 1), dt.datetime(2025, 1, 1)]),
        ("decimal(38,2)", [Decimal("-9e30"), Decimal("-1.50"), Decimal("2.25"), Decimal("9e30")]),
    ],
)
def test_axis_keeps_the_order(spark, kind, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*values, None])], f"i int, v {kind}")
    found = [r[0] for r in df.orderBy("i").select(on_axis(F.col("v"), df.schema["v"].dataType)).collect()]
    assert found[-1] is None and found[:-1] == sorted(found[:-1]) and len(set(found)) > 1 and all(LEAST <= x <= MOST for x in found[:-1])
    with pytest.raises(ValueError, match="no order"):
        on_axis(F.col("v"), T.MapType(T.StringType(), T.StringType()))


@pytest.mark.parametrize("limit", [10**9, 0])
def test_long_intervals_equal_a_plain_join(spark, limit):
    rng = random.Random(4)
    start = dt.datetime(2020, 1, 1)
    at = lambda: start + dt.timedelta(seconds=rng.randint(0, 3 * 365 * 86400), microseconds=rng.randint(0, 999_999))
    intervals = [(i, a, a + dt.timedelta(seconds=rng.choice([-5, 0, 1, 3600, 86400 * 900]))) for i, a in ((i, at()) for i in range(60))] + [(99, None, start)]
    events = [(i, at()) for i in range(400)] + [(1000 + i, x) for i, (_, x, _) in enumerate(intervals[:60])] + [(2000 + i, x) for i, (_, _, x) in enumerate(intervals[:60])] + [(5000, None)]
    calendar = spark.createDataFrame(intervals, "interval int, start timestamp_ntz, end timestamp_ntz")
    found = long_interval_join(spark.createDataFrame(events, "id int, ts timestamp_ntz"), "ts", calendar, broadcast_limit=limit, salts=3)
    assert found.columns == ["id", "ts", "interval", "start", "end"]
    expected = sorted((e, i) for e, t in events for i, a, b in intervals if None not in (t, a) and a <= t < b)
    assert sorted((r.id, r.interval) for r in found.collect()) == expected
