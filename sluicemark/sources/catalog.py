"""Catalog scans and column descriptors as data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_COLUMNS = "table_name string, column_name string, ordinal int, column_type string"


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Tables and views of a database, temporary views left out."""
    return spark.sql(f"SHOW TABLES IN {database}").where("NOT isTemporary").select(F.col("tableName").alias("table_name"))


def list_columns(spark: SparkSession, tables: list[str]) -> DataFrame:
    """Columns of catalog tables in order, names upper-cased."""
    rows = [
        (table.split(".")[-1].upper(), column.name.upper(), ordinal, column.dataType.simpleString())
        for table in tables
        for ordinal, column in enumerate(spark.table(table).schema.fields, start=1)
    ]
    return spark.createDataFrame(rows, _COLUMNS)


def value_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows and non-null values of each column: one scan and one map-side aggregate per table."""
    def counts(name: str, df: DataFrame) -> DataFrame:
        columns = F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.count(F.col(f"`{c}`")).alias("n_values")) for c in df.columns
        ])
        one = df.agg(F.count(F.lit(1)).alias("n_rows"), columns.alias("_columns"))
        return one.select(F.lit(name).alias("table_name"), "n_rows", F.inline("_columns"))

    return reduce(DataFrame.unionByName, [counts(n, df) for n, df in frames.items()])


def describe_frames(frames: dict[str, DataFrame]) -> DataFrame:
    """One descriptor per column: position, type, and whether any of its values is null."""
    types = F.create_map(*[
        F.lit(x)
        for name, df in frames.items()
        for ordinal, field in enumerate(df.schema.fields, start=1)
        for x in (f"{name}.{field.name}", f"{ordinal} {field.dataType.simpleString()}")
    ])
    described = value_counts(frames).withColumn(
        "_type", F.split(types[F.concat_ws(".", "table_name", "column_name")], " ", 2)
    )
    return described.select(
        "table_name",
        F.col("_type")[0].cast("int").alias("order_id"),
        "column_name",
        F.col("_type")[1].alias("type"),
        (F.col("n_values") < F.col("n_rows")).alias("nullable"),
    )


def rows_to_objects(descriptors: DataFrame, by: list[str], order: str) -> DataFrame:
    """Rows of each group as a JSON array of objects, ordered.

    Meant for column descriptors, where a group is bounded by the width of one table.
    """
    rest = [c for c in descriptors.columns if c not in by]
    objects = F.array_sort(F.collect_list(F.struct(order, *[c for c in rest if c != order])))
    return descriptors.groupBy(*by).agg(F.to_json(objects).alias("objects"))
