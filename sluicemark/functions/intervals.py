"""Uneven daily intervals [06:00, 16:30) and [16:30, next 06:00), and time slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Hour of the run -> storage slot.
SLOTS = {12: "morning", 16: "afternoon", 20: "evening"}
OTHER_SLOT = "manual"


def _after(day: Column, hours: int, minutes: int = 0) -> Column:
    return day.cast("timestamp_ntz") + F.expr(f"make_dt_interval(0, {hours}, {minutes}, 0)")


def minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def completed_key(day: Column, minute: Column) -> tuple[Column, Column]:
    """Last completed interval as the day it ends on and whether it is the night one.

    From 06:00 to 16:30 that is the night up to today; before and after it is the daytime of
    yesterday and of today.  Both comparisons are exact to the minute.
    """
    return F.when(minute < 6 * 60, F.date_sub(day, 1)).otherwise(day), minute.between(6 * 60, 16 * 60 + 30)


def key_bounds(day: Column, night: Column) -> tuple[Column, Column]:
    """Start and end of the interval a ``completed_key`` names."""
    return (
        F.when(night, _after(F.date_sub(day, 1), 16, 30)).otherwise(_after(day, 6)),
        F.when(night, _after(day, 6)).otherwise(_after(day, 16, 30)),
    )


def completed_interval(ts: Column) -> Column:
    """Last completed interval before ``ts`` as ``struct<start, end>``."""
    start, end = key_bounds(*completed_key(F.to_date(ts), minute_of_day(ts)))
    return F.when(ts.isNotNull(), F.struct(start.alias("start"), end.alias("end")))


def interval_calendar(bounds: DataFrame, first: str, latest: str) -> DataFrame:
    """Two intervals per day from the day of ``first``; an interval starts no later than ``latest``."""
    from_day, to_day = F.to_date(F.col(first)), F.to_date(F.col(latest))
    days = F.when(from_day <= to_day, F.sequence(from_day, to_day, F.expr("interval 1 day")))
    day = F.col("_day")
    both = F.array(
        F.struct(_after(day, 6).alias("start"), _after(day, 16, 30).alias("end")),
        F.struct(_after(day, 16, 30).alias("start"), _after(F.date_add(day, 1), 6).alias("end")),
    )
    return (
        bounds.select(F.col(latest).alias("_latest"), F.explode(days).alias("_day"))
        .select("_latest", F.explode(both).alias("_interval"))
        .where(F.col("_interval.start") <= F.col("_latest"))
        .select("_interval.start", "_interval.end")
    )


def time_slot(ts: Column) -> Column:
    """Storage slot of a run time."""
    slot = F.lit(OTHER_SLOT)
    for hour, name in SLOTS.items():
        slot = F.when(F.hour(ts) == hour, F.lit(name)).otherwise(slot)
    return slot
