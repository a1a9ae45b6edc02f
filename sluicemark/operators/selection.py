"""Projections, filters and bound-parameter SQL."""

from __future__ import annotations

import datetime as dt
from fnmatch import fnmatchcase
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def in_date_range(df: DataFrame, column: str, start: dt.date, end: dt.date) -> DataFrame:
    """Rows whose day is in ``[start, end)``; Catalyst turns the day test into pushed bounds."""
    day = F.to_date(column)
    return df.where((day >= F.lit(start)) & (day < F.lit(end)))


def in_comma_list(df: DataFrame, column: str, ids: str) -> DataFrame:
    """Rows whose value is in comma-separated text, read in the column's own type."""
    kind = df.schema[column].dataType
    return df.where(F.col(column).isin([F.lit(item).cast(kind) for item in comma_values(ids, str)]))


def run_sql_file(spark: SparkSession, path: str | Path, params: dict[str, Any], **frames: DataFrame) -> DataFrame:
    """Run a ``.sql`` file with its named parameters bound, never spliced into the text.

    ``frames`` stand for the ``{name}`` table references of the text.
    """
    return spark.sql(Path(path).read_text(), args=params, **frames)


def comma_values(text: str, kind: type = int) -> list:
    """Comma-separated parameter text as a typed list, to be bound as an array."""
    return [kind(item.strip()) for item in text.split(",")]


def default_range_params(today: dt.date, ids: str = "10, 11, 12") -> dict[str, Any]:
    """Defaults of the range query: yesterday, today (excluded), the id list."""
    return {
        "start_date": today - dt.timedelta(days=1),
        "end_date": today,
        "ids": comma_values(ids),
    }


def select_by_pattern(df: DataFrame, patterns: list[str], stream: str | None = None) -> DataFrame:
    """Columns by ordered patterns ``stream.column``; ``!`` patterns take columns out again.

    Patterns without a stream apply to any frame.  Columns appear in pattern order, each once.
    """
    def matches(pattern: str, column: str) -> bool:
        head, dot, tail = pattern.partition(".")
        if not dot:
            return fnmatchcase(column, pattern)
        return (stream is None or fnmatchcase(stream, head)) and fnmatchcase(column, tail)

    excluded = [p[1:] for p in patterns if p.startswith("!")]
    chosen = dict.fromkeys(
        c
        for p in patterns
        if not p.startswith("!")
        for c in df.columns
        if matches(p, c) and not any(matches(x, c) for x in excluded)
    )
    if not chosen:
        raise ValueError(f"patterns {patterns} select no column of {df.columns}")
    return df.select(*[f"`{c}`" for c in chosen])


def from_start(df: DataFrame, column: str, start: Column) -> DataFrame:
    """Rows from the replication start onwards."""
    return df.where(F.col(column) >= start)


def add_constant(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df.withColumn(name, value)
