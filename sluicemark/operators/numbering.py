"""Global row numbers without a single task: counts per partition, their sums, and a number from each row's place."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicemark.session import staged

PART, PLACE = "_part", "_place"
_IN_PARTITION = (1 << 33) - 1  # the low bits of monotonically_increasing_id


def numbered(df: DataFrame, number: str, first_of_each: int | None = None) -> DataFrame:
    """The rows, numbered from 0 without gaps in the order of the frame's partitions.

    Rows are written once with their place in their partition, so a repeated task changes no number.  One count per partition comes to
    the driver, which tracks as many tasks, and goes back as a broadcast.  ``first_of_each`` keeps only that many rows of each partition.
    """
    placed = df.withColumns({PART: F.spark_partition_id(), PLACE: F.monotonically_increasing_id().bitwiseAND(_IN_PARTITION)})
    if first_of_each is not None:
        placed = placed.where(F.col(PLACE) < first_of_each)
    written = staged(placed, "numbered")
    counts = sorted(written.groupBy(PART).count().collect())
    starts = [0, *accumulate(row["count"] for row in counts)]
    offsets = df.sparkSession.createDataFrame([(row[PART], start) for row, start in zip(counts, starts)], "_own_part int, _start long")
    joined = written.join(F.broadcast(offsets), F.col(PART) == F.col("_own_part"))
    return joined.select(*[f"`{c}`" for c in df.columns], (F.col("_start") + F.col(PLACE)).alias(number))
