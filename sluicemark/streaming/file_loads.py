"""Load each file once, through Structured Streaming's file history."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sluicemark.sources.files import PROVENANCE
from sluicemark.sources.loading import FILES_PER_BATCH, load_files, loaded_rows, parse_raw, raw_files

BATCH = "load_batch"


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def run_once(stream: DataFrame, checkpoint: str, batch: Callable[[DataFrame, int], None]) -> None:
    """Hand everything that is available now to ``batch(rows, batch_id)``, then stop."""
    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def for_new_files(
    spark: SparkSession,
    stage: str,
    prefix: str,
    file_format: str,
    schema: T.StructType,
    checkpoint: str,
    handle: Callable[[DataFrame, int], None],
    scan_time: dt.datetime | None = None,
    on_error: str = "abort",
    files_per_batch: int = FILES_PER_BATCH,
) -> None:
    """Hand the rows of files not seen before to ``handle(rows, batch_id)``, whatever the files' dates are.

    Rows are matched by name and stamped as in a batch load.
    """
    def batch(raw: DataFrame, batch_id: int) -> None:
        handle(loaded_rows(parse_raw(raw, file_format, schema), scan_time, on_error), batch_id)

    run_once(raw_files(spark, stage, prefix, file_format, schema, streaming=files_per_batch), checkpoint, batch)


def load_new_files(
    spark: SparkSession,
    stage: str,
    prefix: str,
    file_format: str,
    schema: T.StructType,
    table: str,
    checkpoint: str,
    scan_time: dt.datetime | None = None,
    on_error: str = "abort",
    force: bool = False,
    files_per_batch: int = FILES_PER_BATCH,
) -> None:
    """Append rows of new files under ``stage/prefix`` to the files at ``table``.

    Each micro-batch owns the folder named by its id and overwrites it, so a batch repeated
    after a crash leaves its rows once.  ``force`` loads every file, seen before or not, and
    leaves the history as it is.
    """
    def append(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{table}/{BATCH}={batch_id}")

    if force:
        load_files(spark, stage, prefix, file_format, schema, scan_time, on_error).write.parquet(
            f"{table}/{BATCH}=forced-{uuid.uuid4().hex}"
        )
    else:
        for_new_files(spark, stage, prefix, file_format, schema, checkpoint, append, scan_time, on_error, files_per_batch)


def truncate_loaded(spark: SparkSession, table: str, checkpoint: str) -> None:
    """Remove the rows and the load history, so the same files load again."""
    delete_path(spark, checkpoint)
    delete_path(spark, table)


def read_loaded(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """Rows loaded so far."""
    provenance = {f.name for f in PROVENANCE}
    data = [f for f in schema.fields if f.name.lower() not in provenance]
    rows = spark.read.schema(T.StructType(data + PROVENANCE.fields)).parquet(table)
    return rows.select(*[f"`{f.name}`" for f in data], *PROVENANCE.names)
