"""Writes: unload, chunked export, skip-when-empty, append, date-keyed landing."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicemark.functions.intervals import time_slot
from sluicemark.operators.numbering import numbered
from sluicemark.session import move_partitions
from sluicemark.sources.files import CSV, CsvFormat, reader_format, write_options

CHUNK_ROWS = 10_000


# A limit up to this many rows is one task's work.
ROWS_IN_ONE_TASK = 100_000


def limit_rows(df: DataFrame, n: int | None, in_one_task: int = ROWS_IN_ONE_TASK) -> DataFrame:
    """Any ``n`` rows, or the first ``n`` of a sorted frame; 0 or None means all.

    Every task stops after its first ``n`` rows.  Up to ``in_one_task``, one task takes ``n`` of what they send; a larger limit leaves
    the rows where they are and each task keeps its share, found from the counts of the partitions before.
    """
    if not n or n <= in_one_task:
        return df.limit(n) if n else df
    return numbered(df, "_number", first_of_each=n).where(F.col("_number") < n).drop("_number")


def unload(df: DataFrame, folder: str, file_format: str, limit: int | None = None, csv: CsvFormat = CSV) -> str:
    """Write rows as files with header into a directory; 0 or None as limit means all rows."""
    folder = folder if folder.endswith("/") else f"{folder}/"
    reader = reader_format(file_format)
    limit_rows(df, limit).write.format(reader).options(**write_options(reader, csv)).save(folder)
    return folder


def write_skip_empty(df: DataFrame, path: str) -> bool:
    """Snappy parquet at ``path + ".parquet"`` (suffix added once); an empty frame writes nothing."""
    if not df.isEmpty():
        target = path if path.endswith(".parquet") else f"{path}.parquet"
        df.write.mode("overwrite").option("compression", "snappy").parquet(target)
    return True


def export_chunks(
    df: DataFrame, folder: str, file_format: str = "parquet", rows_per_file: int = CHUNK_ROWS, csv: CsvFormat = CSV
) -> None:
    """Write all rows in files of at most ``rows_per_file`` rows; every task cuts its own files."""
    reader = reader_format(file_format)
    (
        df.write.mode("overwrite")
        .format(reader)
        .options(**write_options(reader, csv))
        .option("maxRecordsPerFile", rows_per_file)
        .save(folder)
    )


def export_numbered_chunks(
    df: DataFrame,
    folder: str,
    table: str,
    day: dt.date,
    file_format: str = "parquet",
    rows_per_file: int = CHUNK_ROWS,
    csv: CsvFormat = CSV,
    parallel: int = 16,
) -> int:
    """Write all rows as files ``<table>-<day>-chunk-<n>`` with n from 1, each but the last with ``rows_per_file`` rows; returns how many.

    Rows are numbered over all partitions in two phases, then dealt by chunk, so a chunk is one file and no task sees them all.
    Spark names files itself; they get theirs by one rename each once all are written.  A rerun replaces the chunks of that table and day.
    """
    spark, reader = df.sparkSession, reader_format(file_format)
    chunked = numbered(df, "_number").withColumn("_chunk", F.floor(F.col("_number") / rows_per_file) + 1).drop("_number")
    aside = f"{folder.rstrip('/')}/_{table}-{day:%Y-%m-%d}-{uuid.uuid4().hex}"
    ordered = chunked.repartition("_chunk").sortWithinPartitions("_chunk")
    ordered.write.format(reader).options(**write_options(reader, csv)).partitionBy("_chunk").save(aside)
    stem = f"{folder.rstrip('/')}/{table}-{day:%Y-%m-%d}-chunk-"
    return move_partitions(spark, aside, "_chunk", stem, f".{reader}", parallel)


def append_to_table(df: DataFrame, table: str) -> None:
    """Append rows by name, creating the table if absent; other sessions' rows stay."""
    df.write.mode("append").saveAsTable(table)


def append_to_database(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    df.write.jdbc(url, table, mode="append", properties=properties or {})


def replace_partitions(df: DataFrame, folder: str, by: list[str], rows_per_file: int = 0) -> None:
    """Rewrite exactly the partitions present in ``df``; the others stay.

    The rebalance hint lets adaptive execution gather small partitions into few files and split
    a hot one over several tasks.  A rerun with the same rows leaves the same content.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*by)
        .parquet(folder)
    )


def land_feeds(records: DataFrame, folder: str, feed: str = "feed", day: str = "run_date") -> None:
    """One write for all feeds, keyed by feed and day; feeds without rows leave nothing behind."""
    replace_partitions(records, folder, [feed, day])


def route_by_slot(df: DataFrame, ts: str, folder: str) -> None:
    """Write rows under the time slot of ``ts``.  Slots are few and fixed, so no shuffle is needed."""
    df.withColumn("slot", time_slot(F.col(ts))).write.mode("overwrite").partitionBy("slot").parquet(folder)
