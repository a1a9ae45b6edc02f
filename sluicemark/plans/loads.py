"""Loads that keep their own history of files, so that what was loaded is known without reading the target."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicemark.operators.export import replace_partitions
from sluicemark.plans.snapshots import compact_snapshot, create_snapshot_table, latest_version, lookup_snapshot, read_snapshot, upsert_snapshot
from sluicemark.session import staged
from sluicemark.sources.files import CSV, CsvFormat
from sluicemark.sources.loading import FILES_PER_BATCH, listed_files, load_into_table, loaded_rows, parse_files, same_file

BEGUN, LOADED = "begun", "loaded"


def _exists(spark: SparkSession, history: str) -> bool:
    try:
        latest_version(spark, history)
        return True
    except ValueError:
        return False


def unseen_files(spark: SparkSession, history: str, listed: DataFrame) -> DataFrame:
    """Rows of ``listed`` (with a ``file``) that the history does not hold as loaded.

    The history is a versioned table keyed by file, so its own files are pruned by name before any is read.
    """
    if not _exists(spark, history):
        return listed
    known = lookup_snapshot(spark, history, listed.select("file")).where(F.col("state") == LOADED)
    return listed.join(known.select("file"), "file", "left_anti")


def record_files(spark: SparkSession, history: str, files: DataFrame, state: str) -> None:
    """Note a state of files (a frame with ``file``), in one commit; small files of the history are put together now and then."""
    rows = files.select("file", F.lit(state).alias("state"), F.current_timestamp().cast("timestamp_ntz").alias("changed")).distinct()
    if _exists(spark, history):
        upsert_snapshot(history, rows)
        compact_snapshot(spark, history)
    else:
        create_snapshot_table(rows, history, ["file"])


def _settle(spark: SparkSession, table: str, history: str, listed: DataFrame) -> None:
    """Loads that began and were not noted as done: their files are in the target, all of them or none."""
    if not _exists(spark, history):
        return
    begun = staged(lookup_snapshot(spark, history, listed.select("file")).where(F.col("state") == BEGUN).select("file"))
    if not begun.isEmpty():
        there = spark.table(table).select(F.col("metadata_filename").alias("file")).join(begun, "file", "left_semi").distinct()
        record_files(spark, history, staged(there), LOADED)


def load_with_history(
    spark: SparkSession,
    table: str,
    stage: str,
    prefix: str,
    file_format: str,
    history: str,
    scan_time: dt.datetime | None = None,
    on_error: str = "abort",
    csv_header: str = "shared",
    csv: CsvFormat = CSV,
    files_per_batch: int = FILES_PER_BATCH,
) -> dict[str, int]:
    """Load files the history does not hold into a table with provenance; returns files_listed, files_loaded, rows_parsed, rows_loaded, errors_seen.

    Files are taken ``files_per_batch`` at a time: their names are noted as begun, their rows are appended by one job, and they are noted
    as loaded.  What comes to the driver are paths of one batch.  A run that died in between is settled by the next one, which looks for the begun files,
    and only those, in the target.  Two runs at a time are told apart by the history's commits: the second is refused.
    """
    listed = staged(listed_files(spark, stage, prefix), "listed")
    total = {"files_listed": listed.count(), "files_loaded": 0, "rows_parsed": 0, "rows_loaded": 0, "errors_seen": 0}
    _settle(spark, table, history, listed)
    new = staged(unseen_files(spark, history, listed), "unseen")
    batches = max(1, -(-new.count() // files_per_batch))
    for batch in range(batches):
        # Dealt by a hash of the name, so batches are about even and need no order of all names.
        chosen = new.where(F.pmod(F.xxhash64("file"), F.lit(batches)) == batch)
        paths = [same_file(row["path"]) for row in chosen.select("path").collect()]
        if not paths:
            continue
        record_files(spark, history, chosen, BEGUN)
        done = load_into_table(
            spark, table, stage, prefix, file_format, scan_time=scan_time, on_error=on_error, csv_header=csv_header, csv=csv, paths=paths
        )
        record_files(spark, history, chosen, LOADED)
        total["files_loaded"] += len(paths)
        for name, n in done.items():
            total[name] += n
    return total


def backfill_late_files(
    spark: SparkSession,
    stage: str,
    prefix: str,
    file_format: str,
    schema: T.StructType,
    ts: str,
    folder: str,
    home: str,
    work: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    csv: CsvFormat = CSV,
) -> list[dt.date]:
    """Take new files, however late they are, and rewrite exactly the days they have rows for; returns those days.

    ``home`` keeps the history of files and an index of the days each file touches.  A day is worked out from all files that touch it, and no other file is
    read; ``work`` sees rows with their ``run_date`` and must keep it.  The new files count as taken once their days are written, so a run that died is
    repeated with the same result.
    """
    history, index = f"{home}/files", f"{home}/days"
    listed = staged(listed_files(spark, stage, prefix), "listed")
    new = staged(unseen_files(spark, history, listed), "unseen")

    def rows_of(files: DataFrame) -> DataFrame:
        paths = [same_file(row["path"]) for row in files.select("path").collect()]
        parsed = parse_files(spark, stage, prefix, file_format, schema, csv=csv, paths=paths)
        return loaded_rows(parsed).withColumn("run_date", F.to_date(ts))

    if new.isEmpty():
        return []
    touched = staged(rows_of(new).select(F.col("metadata_filename").alias("file"), F.col("run_date").alias("day")).where("day IS NOT NULL").distinct(), "touched")
    if _exists(spark, index):
        upsert_snapshot(index, touched)
    else:
        create_snapshot_table(touched, index, ["day", "file"])
    days = sorted(row["day"] for row in touched.select("day").distinct().collect())
    if days:
        needed = read_snapshot(spark, index).where(F.col("day").isin(days)).select("file").distinct()
        rows = rows_of(listed.join(needed, "file", "left_semi")).where(F.col("run_date").isin(days))
        replace_partitions(work(rows.drop("metadata_filename", "metadata_ingest_time")), folder, ["run_date"])
    record_files(spark, history, new, LOADED)
    return days
