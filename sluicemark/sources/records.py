"""Landed JSON record payloads and inline rows."""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicemark.functions.dates import ntz


_REFUSED = "_refused"


def _parsed(payloads: DataFrame, payload: str, record: T.StructType, keep: list[str]) -> DataFrame:
    """Kept columns, ``_record`` and ``_refused``: each record of the arrays, or the text that is none.

    An array is first cut into the texts of its elements, so a fault costs that element only.  A payload that is no array is
    refused as a whole; null, ``null`` and an empty array hold no record and no fault.
    """
    text = F.col(f"`{payload}`")
    cut = payloads.select(*keep, text.alias("_payload"), F.from_json(text, "array<string>").alias("_texts"))
    broken = F.col("_texts").isNull() & F.col("_payload").isNotNull() & (F.trim("_payload") != "null")
    texts = F.when(broken, F.array(F.col("_payload"))).otherwise(F.col("_texts"))
    each = cut.select(*keep, broken.alias("_broken"), F.explode(texts).alias("_text"))
    schema = T.StructType([*record.fields, T.StructField(_REFUSED, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _REFUSED}
    # The one-element explode keeps the parse from being copied into every column taken from it.
    read = each.select(*keep, "_broken", "_text", F.explode(F.array(F.from_json("_text", schema, options))).alias("_record"))
    fault = F.when(F.col("_broken") | F.col("_record").isNull(), F.coalesce("_text", F.lit("null"))).otherwise(F.col("_record")[_REFUSED])
    return read.select(*keep, "_record", fault.alias(_REFUSED))


def records_from_payload(
    payloads: DataFrame,
    payload: str,
    record: T.StructType,
    scrape_ts: Column,
    keep: list[str] | None = None,
    on_error: str = "abort",
) -> DataFrame:
    """One row per record of each JSON array in ``payload``, stamped with ``scrape_ts``.

    A payload or record that doesn't parse, or holds a value of another type, fails the job; with
    ``on_error="continue"`` it is left out and counted by ``refused_records``.
    A generator keeps the work on the payload's own partition: no shuffle.
    """
    if on_error not in ("abort", "continue"):
        raise ValueError(f"on_error must be 'abort' or 'continue', not {on_error!r}")
    parsed, bad = _parsed(payloads, payload, record, keep or []), F.col(_REFUSED).isNotNull()
    if on_error == "continue":
        kept = parsed.where(~bad)
    else:
        message = F.concat(F.lit("bad record: "), F.col(_REFUSED))
        kept = parsed.where(F.when(bad, F.raise_error(message).cast("boolean")).otherwise(True))
    return kept.select(*(keep or []), *[F.col("_record")[f.name].alias(f.name) for f in record], scrape_ts.alias("scrape_ts"))


def landed_and_refused(payloads: DataFrame, payload: str, record: T.StructType, scrape_ts: Column, keep: list[str] | None = None) -> DataFrame:
    """Rows of ``records_from_payload`` under ``"continue"`` and of ``refused_records`` from one reading of the payloads.

    ``refused`` is the text of what was refused, and null for a landed record; a refused one has null fields and no time.
    """
    parsed, fine = _parsed(payloads, payload, record, keep or []), F.col(_REFUSED).isNull()
    fields = [F.when(fine, F.col("_record")[f.name]).alias(f.name) for f in record]
    return parsed.select(*(keep or []), *fields, F.when(fine, scrape_ts).alias("scrape_ts"), F.col(_REFUSED).alias("refused"))


def refused_records(payloads: DataFrame, payload: str, record: T.StructType, keep: list[str] | None = None) -> DataFrame:
    """What ``records_from_payload`` leaves out under ``"continue"``: kept columns and the refused text."""
    refused = _parsed(payloads, payload, record, keep or []).where(F.col(_REFUSED).isNotNull())
    return refused.select(*(keep or []), F.col(_REFUSED).alias("refused"))


def records_from_files(spark: SparkSession, path: str, record: T.StructType, scrape_ts: Column) -> DataFrame:
    """Rows of landed files that each hold one JSON array; a file is one task's work, a broken one an error."""
    return spark.read.schema(record).json(path, multiLine=True, mode="FAILFAST").withColumn("scrape_ts", scrape_ts)


def inline_rows(
    spark: SparkSession, rows: list[tuple[Any, ...]], schema: str | T.StructType, run_ts: dt.datetime, name: str = "created"
) -> DataFrame:
    """Literal rows with the run timestamp repeated on each."""
    return spark.createDataFrame(rows, schema).withColumn(name, ntz(run_ts))
