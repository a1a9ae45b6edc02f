"""Dyadic cells: ranges of whole numbers as few aligned blocks, so that "a point lies in a range" becomes equality of keys.

A cell of level l holds the 2^l numbers that agree but for their last l bits.  A range of n numbers is the disjoint union of at most
2 log2(n) cells; a number lies in one cell per level.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Numbers lie within these bounds, so that the length of a range is a long.
LEAST, MOST = -(1 << 61), 1 << 61


def _shift(value: Column, bits: Column | int) -> Column:
    return F.call_function("shiftright", value, bits if isinstance(bits, Column) else F.lit(bits))


def cells_of_range(first: Column, last: Column) -> Column:
    """The cells ``(level, cell)`` that make up the range, both ends included; none if it is empty or has a null end."""
    first, end = first.cast("long"), last.cast("long") + 1

    def at(level: Column) -> Column:
        left, right = -_shift(-first, level), _shift(end, level)
        cell = lambda number: F.struct(level.alias("level"), number.alias("cell"))
        return F.array(
            F.when((left < right) & (left.bitwiseAND(1) == 1), cell(left)), F.when((left < right) & (right.bitwiseAND(1) == 1), cell(right - 1))
        )

    levels = F.when(first < end, F.sequence(F.lit(0), F.length(F.bin(end - first)).cast("int")))
    return F.coalesce(F.array_compact(F.flatten(F.transform(levels, at))), F.array().cast("array<struct<level:int,cell:bigint>>"))


def cells_of_point(point: Column, levels: list[int]) -> Column:
    """The cell of the number at each of the levels; none for null."""
    cells = [F.struct(F.lit(level).alias("level"), _shift(point.cast("long"), level).alias("cell")) for level in levels]
    return F.when(point.isNotNull(), F.array(*cells) if cells else F.array().cast("array<struct<level:int,cell:bigint>>"))


def hour_number(ts: Column) -> Column:
    """Hours since 1970 of a timestamp without time zone."""
    return F.unix_date(F.to_date(ts)).cast("long") * 24 + F.hour(ts)


def on_axis(value: Column, kind: T.DataType) -> Column:
    """A whole number that never falls where the value rises, for any type that can be a key; null stays null.

    Texts go by their first seven bytes, other types by what keeps their order best within ``LEAST`` and ``MOST``.
    """
    if isinstance(kind, (T.StringType, T.BinaryType)):
        octets = F.rpad(F.hex(F.substring(value.cast("binary"), 1, 7)), 14, "0")
        return F.conv(octets, 16, 10).cast("long")
    if isinstance(kind, T.BooleanType):
        return value.cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("long")
    if isinstance(kind, T.TimestampNTZType):
        return hour_number(value) * 3600 + F.minute(value) * 60 + F.floor(F.second(value))
    if isinstance(kind, T.TimestampType):
        return F.unix_seconds(value)
    within = lambda number: F.when(number < LEAST, LEAST).when(number > MOST, MOST).otherwise(number).cast("long")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(F.isnan(value), MOST).otherwise(within(F.when(F.abs(value) < 2e18, F.floor(value)).otherwise(value)))
    if isinstance(kind, T.DecimalType):
        return within(F.floor(value))
    if isinstance(kind, T.IntegralType):
        return within(value.cast("long"))
    raise ValueError(f"a key of type {kind.simpleString()} has no order to go by")
