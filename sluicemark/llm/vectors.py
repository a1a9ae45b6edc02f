"""Blocks of vectors, and every block of one table against every block of queries."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicemark.session import staged


def finite(vector: Column) -> Column:
    """True for a vector that is not null and whose components are all finite."""
    inside = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return vector.isNotNull() & F.coalesce(inside, F.lit(False)) & (F.size(vector) > 0)


def distinct_vectors(rows: DataFrame, copies: int) -> DataFrame:
    """(v, ids): each vector of ``rows`` (id, v) once, with its ``copies`` smallest ids.

    A search for fewer rows than that never needs another copy.  The limit is applied before the
    shuffle, so a vector that a third of all rows share costs a few rows per task.
    """
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = rows.withColumn("place", place).filter(F.col("place") <= copies)
    return staged(few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")))


def block_count(df: DataFrame, rows: int) -> int:
    return max(1, -(-df.count() // rows))


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def against(
    table: DataFrame, queries: DataFrame, table_blocks: int, query_blocks: int, keys: list[str], run: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """``run`` on each block of ``table`` with each block of ``queries`` that has the same ``keys``.

    Each side is sent once per block of the other, the least that a stated query set against all rows can take;
    a task holds one block of either.
    """

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    left = table.select("*", every(query_blocks).alias("q_block"))
    right = queries.select("*", every(table_blocks).alias("t_block"))
    by = [*keys, "t_block", "q_block"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(run, schema)


def stacked(column: pd.Series, dtype: type = np.float64) -> np.ndarray:
    return np.stack(column.to_list()).astype(dtype)
