"""Database scans through JDBC, split over tasks, and full or incremental selection."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The two run types.
FULL, INCREMENTAL = "Full Backfill", "Incremental"


def jdbc_options(
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    split_column: str | None = None,
    bounds: tuple | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    is_query: bool = False,
) -> dict[str, str]:
    """Reader options of ``scan_database``; ``table`` is a query if ``is_query`` says so."""
    options = {
        "url": url,
        "dbtable": f"({table}) q" if is_query else table,
        "fetchsize": str(fetch_size),
        **(properties or {}),
    }
    if split_column is None:
        return options
    if bounds is None:
        raise ValueError("a split column needs its lower and upper bound")
    return options | {
        "partitionColumn": split_column,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(partitions),
    }


def scan_database(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """Rows of a table or query; with a split column the read runs as that many range queries.

    Filters and column choices made on the result are pushed into the database by Spark.
    The bounds only place the splits: rows outside them are read too.  For the options see
    ``jdbc_options``.
    """
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def select_run(df: DataFrame, date_column: str, run_type: str, run_date: dt.date) -> DataFrame:
    """All rows for a full backfill; for an incremental run those from the day before ``run_date``."""
    if run_type == FULL:
        return df
    if run_type != INCREMENTAL:
        raise ValueError(f"run_type must be {FULL!r} or {INCREMENTAL!r}, not {run_type!r}")
    return df.where(F.to_date(date_column) >= F.date_sub(F.lit(run_date), 1))
