"""Row-count check and row constraints."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class CheckError(Exception):
    """A table did not pass its check."""


def row_count(df: DataFrame, name: str, threshold: int = 0) -> DataFrame:
    """One row: table name, row count, and whether the count is above the threshold."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"),
        "n_rows",
        F.lit(threshold).cast("long").alias("threshold"),
        (F.col("n_rows") > threshold).alias("passed"),
    )


def check_row_count(df: DataFrame, name: str, threshold: int = 0) -> int:
    """The row count, or an error when it is not above the threshold."""
    found = row_count(df, name, threshold).first()
    if not found["passed"]:
        raise CheckError(f"table {name} has {found['n_rows']} rows, needs more than {threshold}")
    return found["n_rows"]


# Accepted text formats.
_FORMATS = {
    "date": lambda c: c.rlike(r"^\d{4}-\d{2}-\d{2}$") & c.try_cast("date").isNotNull(),
    "date-time": lambda c: c.rlike(r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}") & c.try_cast("timestamp").isNotNull(),
    "time": lambda c: c.rlike(r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d+)?(Z|[+-]([01]\d|2[0-3]):?[0-5]\d)?$"),
}


@dataclass(frozen=True)
class Rule:
    """Constraints of one column; bounds are inclusive, a null passes all but ``required``."""

    column: str
    required: bool = False
    one_of: tuple[Any, ...] | None = None
    min_length: int | None = None
    max_length: int | None = None
    minimum: float | None = None
    maximum: float | None = None
    constant: Any = None
    text_format: str | None = None

    def violations(self) -> list[tuple[str, Column]]:
        """Each constraint's name and the condition under which a row breaks it."""
        value = F.col(f"`{self.column}`")
        found: list[tuple[str, Column]] = []
        if self.required:
            found.append(("required", value.isNull()))
        if self.one_of is not None:
            found.append(("one_of", ~value.isin(list(self.one_of))))
        if self.min_length is not None:
            found.append(("min_length", F.char_length(value) < self.min_length))
        if self.max_length is not None:
            found.append(("max_length", F.char_length(value) > self.max_length))
        if self.minimum is not None:
            found.append(("minimum", value < self.minimum))
        if self.maximum is not None:
            found.append(("maximum", value > self.maximum))
        if self.constant is not None:
            found.append(("constant", value != F.lit(self.constant)))
        if self.text_format is not None:
            found.append(("format", ~_FORMATS[self.text_format](value.cast("string"))))
        return found


def count_violations(df: DataFrame, rules: list[Rule], name: str = "") -> DataFrame:
    """Violations per rule, all counted in one pass and unpivoted from a single row."""
    checks = [(r.column, kind, broken) for r in rules for kind, broken in r.violations()]
    if not checks:
        raise ValueError("no constraint given")
    counted = df.agg(
        F.array(
            *[
                F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("rule"), F.count_if(broken).alias("violations"))
                for c, kind, broken in checks
            ]
        ).alias("_checks")
    )
    return counted.select(F.lit(name).alias("table_name"), F.inline("_checks"))


def passing_rows(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows that break no rule."""
    broken = [F.coalesce(b, F.lit(False)) for r in rules for _, b in r.violations()]
    return df.where(~reduce(lambda a, b: a | b, broken, F.lit(False)))
