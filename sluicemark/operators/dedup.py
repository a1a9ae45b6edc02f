"""High-watermark filter and latest row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicemark.functions.dates import ntz
from sluicemark.session import resolve

# Fixed value: watermark of an empty target.
NO_WATERMARK = "1900-01-01 00:00:00"


def max_or_default(target: DataFrame, column: str) -> DataFrame:
    """One row with the column's maximum, or the default for an empty target."""
    column = resolve(target, [column])[0]
    kind = target.schema[column].dataType
    return target.select(F.coalesce(F.max(column), ntz(NO_WATERMARK).cast(kind)).alias("watermark"))


def above_watermark(source: DataFrame, target: DataFrame, column: str | None, mark: DataFrame | None = None) -> DataFrame:
    """Source rows strictly above the target's maximum; no column, no filter.

    The maximum is a scalar subquery of the type of the source column, so the comparison
    reaches the source scan as a pushed filter and nothing comes to the driver first.  ``mark``, one row with a
    ``watermark``, takes the place of the target's present maximum.
    """
    if column is None:
        return source
    own = resolve(source, [column])[0]
    kind = source.schema[own].dataType
    highest = (max_or_default(target, column) if mark is None else mark).select(F.col("watermark").cast(kind))
    return source.where(F.col(own) > highest.scalar())


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[str | Column]) -> DataFrame:
    """Exactly one row per key: the first by ``order_by``, by default descending, nulls last.

    Null keys form one group.  The rank filter becomes a group limit on the map side too, so
    each task sends at most one row per key to the shuffle and a hot key stays small.
    End ``order_by`` with a tie-break column to make the choice repeatable.
    """
    if not keys or not order_by:
        raise ValueError("keys and order_by fields are required")
    order = [F.col(resolve(df, [o])[0]).desc_nulls_last() if isinstance(o, str) else o for o in order_by]
    window = Window.partitionBy(*resolve(df, keys)).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def deduplicated(
    source: DataFrame,
    target: DataFrame,
    keys: list[str],
    order_by: list[str | Column],
    watermark: str | None = None,
    mark: DataFrame | None = None,
) -> DataFrame:
    """Rows above the target's watermark, latest per key; the filter runs before the ranking."""
    return latest_per_key(above_watermark(source, target, watermark, mark), keys, order_by)
