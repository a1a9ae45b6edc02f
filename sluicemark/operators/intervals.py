"""Event-to-interval join and per-interval aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicemark.functions.dyadic import cells_of_point, cells_of_range, hour_number
from sluicemark.functions.intervals import completed_key, key_bounds, minute_of_day
from sluicemark.session import BROADCAST_LIMIT_BYTES, staged_with_size

SALTS = 32


def interval_join(
    events: DataFrame, ts: str, calendar: DataFrame, broadcast_limit: int = BROADCAST_LIMIT_BYTES, salts: int = SALTS
) -> DataFrame:
    """Events with the ``start`` and ``end`` of the calendar intervals that hold ``start <= ts < end``.

    The calendar is expanded to one row per day an interval touches, so the join has an equality
    key, and staged, so what it derives from is read once.  It is broadcast when its measured size
    allows; beyond that both sides shuffle by day and a salt hashed from the row, the same in a repeated task, so a day with
    a third of all rows spreads over ``salts`` tasks; raise it with the size of the largest day.
    """
    days = F.sequence(F.to_date("start"), F.to_date("end"), F.expr("interval 1 day"))
    expanded = calendar.where("start < end").select("start", "end", F.explode(days).alias("_day"))
    by_day, size = staged_with_size(expanded, "calendar")
    keyed = events.withColumn("_event_day", F.to_date(ts))
    inside = (F.col(ts) >= F.col("start")) & (F.col(ts) < F.col("end"))
    same_day = F.col("_event_day") == F.col("_day")
    if size <= broadcast_limit:
        joined = keyed.join(F.broadcast(by_day), same_day & inside)
    else:
        hashed = [F.col(f"`{f.name}`") for f in events.schema if "map<" not in f.dataType.simpleString()]
        copies = by_day.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        salted = keyed.withColumn("_salt", F.pmod(F.xxhash64(*hashed), F.lit(salts)).cast("int"))
        joined = salted.join(copies, same_day & (F.col("_salt") == F.col("_copy")) & inside)
    return joined.select(*events.columns, "start", "end")


def long_interval_join(
    events: DataFrame, ts: str, calendar: DataFrame, broadcast_limit: int = BROADCAST_LIMIT_BYTES, salts: int = SALTS
) -> DataFrame:
    """As ``interval_join`` for intervals of any length, with all columns of both sides.

    An interval becomes the dyadic cells of the hours it touches, at most 2 log2(n) rows for n hours instead of a row per day; an
    event asks for one cell at each level some interval has, 64 at most.  Cells of an interval are disjoint, so a pair meets once; the exact
    bounds are checked where it does.  Beyond the broadcast limit events are salted by a hash of the row, as in ``interval_join``.
    """
    last = hour_number(F.col("end") - F.expr("interval 1 microsecond"))
    cells = calendar.where("start < end").select("*", F.inline(cells_of_range(hour_number(F.col("start")), last)))
    indexed, size = staged_with_size(cells.withColumnsRenamed({"level": "_i_level", "cell": "_i_cell"}), "cells")
    levels = sorted(row[0] for row in indexed.select("_i_level").distinct().collect())
    asked = events.select("*", F.inline(cells_of_point(hour_number(F.col(ts)), levels))).withColumnsRenamed({"level": "_level", "cell": "_cell"})
    meets = (F.col("_level") == F.col("_i_level")) & (F.col("_cell") == F.col("_i_cell"))
    inside = (F.col(ts) >= F.col("start")) & (F.col(ts) < F.col("end"))
    if size <= broadcast_limit:
        joined = asked.join(F.broadcast(indexed), meets & inside)
    else:
        hashed = [F.col(f"`{f.name}`") for f in events.schema if "map<" not in f.dataType.simpleString()]
        copies = indexed.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        salted = asked.withColumn("_salt", F.pmod(F.xxhash64(*hashed), F.lit(salts)).cast("int"))
        joined = salted.join(copies, meets & (F.col("_salt") == F.col("_copy")) & inside)
    return joined.select(*events.columns, *calendar.columns)


def aggregate_by_interval(events: DataFrame, ts: str, *aggregates: Column) -> DataFrame:
    """Aggregates per last completed uneven interval: one hash aggregate with map-side combine.

    Rows are grouped by day and a flag; the bounds are worked out once per group.
    """
    day, night = completed_key(F.col("_day"), F.col("_minute"))
    placed = events.withColumns({"_day": F.to_date(ts), "_minute": minute_of_day(F.col(ts))})
    grouped = placed.groupBy(day.alias("_end_day"), night.alias("_night")).agg(*aggregates)
    start, end = key_bounds(F.col("_end_day"), F.col("_night"))
    return grouped.select(start.alias("start"), end.alias("end"), "*").drop("_end_day", "_night")
