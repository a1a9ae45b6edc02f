"""Date columns and day rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def parse_day(text: Column) -> Column:
    """``yyyy-MM-dd`` text as a date."""
    return F.to_date(text, "yyyy-MM-dd")


def compact_day(day: Column) -> Column:
    """Date as ``yyyyMMdd`` text."""
    return F.date_format(day, "yyyyMMdd")


def dashed_day(day: Column) -> Column:
    """Date as ``yyyy-MM-dd`` text."""
    return F.date_format(day, "yyyy-MM-dd")


def ntz(value: dt.datetime | str) -> Column:
    """Timestamp literal without time zone, so comparisons with NTZ columns stay pushable."""
    return F.lit(str(value)).cast("timestamp_ntz")


def explode_days(bounds: DataFrame, first: str, last: str, name: str = "run_date") -> DataFrame:
    """One row per day from ``first`` to ``last``, both included; none when first > last or null."""
    days = F.when(
        F.col(first) <= F.col(last), F.sequence(F.col(first), F.col(last), F.expr("interval 1 day"))
    )
    return bounds.withColumn(name, F.explode(days))


def explode_days_descending(bounds: DataFrame, last: str, first: str, name: str = "run_date") -> DataFrame:
    """One row per day from ``last`` down to ``first``, both included."""
    days = F.when(
        F.col(first) <= F.col(last), F.sequence(F.col(last), F.col(first), F.expr("interval -1 day"))
    )
    return bounds.withColumn(name, F.explode(days))


def day_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Inclusive range of days between two ``yyyy-MM-dd`` texts."""
    bounds = spark.range(1).select(parse_day(F.lit(start)).alias("first"), parse_day(F.lit(end)).alias("last"))
    return explode_days(bounds, "first", "last").select("run_date")


def day_range_descending(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Inclusive range of days from ``start`` down to ``end``."""
    bounds = spark.range(1).select(parse_day(F.lit(start)).alias("last"), parse_day(F.lit(end)).alias("first"))
    return explode_days_descending(bounds, "last", "first").select("run_date")
