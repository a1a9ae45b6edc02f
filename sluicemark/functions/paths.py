"""Path text and comma lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Path suffix, Spark reader format, format token.
FORMATS = {
    ".csv": ("csv", "csv_format"),
    ".parquet": ("parquet", "parquet_format"),
    ".json": ("json", "json_format"),
}


def format_token(path: Column) -> Column:
    """Format token of each path; null where the suffix is not supported."""
    token = F.lit(None).cast("string")
    for suffix, (_, name) in FORMATS.items():
        token = F.when(path.endswith(suffix), F.lit(name)).otherwise(token)
    return token


def as_directory(path: Column) -> Column:
    """Path with exactly the trailing slash it needs to name a directory."""
    return F.when(path.endswith("/"), path).otherwise(F.concat(path, F.lit("/")))


def feed_path(feed: Column, day: Column) -> Column:
    """Landing path of a feed on a day; depends on nothing else, so reruns hit the same place."""
    stem = F.concat_ws("-", feed, F.date_format(day, "yyyy-MM-dd"))
    return F.concat_ws("/", F.lit("rest_api_scrapes"), feed, stem)


def chunk_path(folder: Column, table: Column, day: Column, chunk: Column) -> Column:
    """Name of the n-th chunk file of an export, n from 1."""
    return F.concat(folder, F.lit("/"), F.concat_ws("-", table, F.date_format(day, "yyyy-MM-dd"), F.lit("chunk"), chunk.cast("string")))


def comma_list(text: Column, item_type: str | T.DataType = "bigint") -> Column:
    """``"10, 11, 12"`` as a typed array."""
    return F.transform(F.split(text, ","), lambda item: F.trim(item).cast(item_type))
