"""Queries over sources: scans, loads, provenance, file history, records, catalog."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicemark.functions.dates import ntz
from sluicemark.operators.export import append_to_table
from sluicemark.plans.flows import with_provenance
from sluicemark.plans.loads import load_with_history
from sluicemark.queries.registry import query, table
from sluicemark.queries.schema_list import SCHEMAS, columns
from sluicemark.session import new_database, new_folder
from sluicemark.sources import catalog, files
from sluicemark.sources.loading import load_files, load_into_table
from sluicemark.sources.records import inline_rows, landed_and_refused
from sluicemark.streaming.file_loads import BATCH, load_new_files

RUN_TS = dt.datetime(2024, 2, 1, 6, 0, 0)


@query(
    "scan_by_format",
    " UNION ALL ".join(
        f"SELECT '{f}' AS file_format, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
        for f in ("csv", "json", "parquet")
    ),
)
def scan_by_format(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    parts = []
    for name in ("csv", "json", "parquet"):
        path = f"{new_folder(spark, 'scan')}/customer.{name}"
        customer.write.format(name).option("header", True).save(path)
        parts.append(files.scan(spark, path, customer.schema).withColumn("file_format", F.lit(name)))
    return reduce(DataFrame.unionByName, parts)


def _column_rows(name: str, tail: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {i} AS ordinal, count({c}) AS file_values, CAST(0 AS BIGINT) AS table_values FROM {name}"
        for i, (c, _) in enumerate(columns(name), start=1)
    ) + tail


def _column_check(built: DataFrame, listed: DataFrame, source: DataFrame) -> DataFrame:
    """Column order of a built table next to its values and those of the source."""
    in_files = catalog.value_counts({"t": source}).select("column_name", F.col("n_values").alias("file_values"))
    in_table = catalog.value_counts({"t": built}).select("column_name", F.col("n_values").alias("table_values"))
    return (
        listed.select(F.lower("column_name").alias("column_name"), "ordinal")
        .join(in_files, "column_name", "left")
        .join(in_table, "column_name")
        .select("column_name", "ordinal", F.coalesce("file_values", F.lit(0)).alias("file_values"), "table_values")
    )


@query(
    "infer_table_schema",
    _column_rows("orders", " UNION ALL SELECT 'metadata_filename', 7, 0, 0 UNION ALL SELECT 'metadata_ingest_time', 8, 0, 0"),
)
def infer_table_schema(spark: SparkSession, sf: str) -> DataFrame:
    built = f"{new_database(spark, 'infer')}.orders"
    files.create_table_from_files(spark, built, f"{sf}/orders.parquet", "parquet")
    return _column_check(spark.table(built), catalog.list_columns(spark, [built]), table(spark, sf, "orders"))


@query("create_table_like", _column_rows("supplier"))
def create_table_like(spark: SparkSession, sf: str) -> DataFrame:
    database = new_database(spark, "likes")
    source, built = f"{database}.supplier", f"{database}.supplier_copy"
    table(spark, sf, "supplier").write.saveAsTable(source)
    files.create_table_like(spark, source, built)
    files.create_table_like(spark, source, built)
    return _column_check(spark.table(built), catalog.list_columns(spark, [built]), spark.table(source))


@query(
    "load_match_by_name",
    " UNION ALL ".join(
        f"SELECT '{f}' AS prefix, c_custkey, c_name, CAST(NULL AS INTEGER) AS c_nationkey, c_acctbal, c_mktsegment,"
        " TIMESTAMP '2024-02-01 06:00:00' AS metadata_ingest_time FROM customer"
        for f in ("csv", "json", "parquet")
    ),
)
def load_match_by_name(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    shuffled = customer.select(
        F.col("c_mktsegment").alias("C_MKTSEGMENT"),
        F.lit("dropped").alias("extra"),
        F.col("c_acctbal").alias("C_AcctBal"),
        F.col("c_name").alias("C_NAME"),
        F.col("c_custkey").alias("C_CUSTKEY"),
    )
    stage, target = new_folder(spark, "stage"), f"{new_database(spark, 'load')}.customer"
    spark.createDataFrame([], with_provenance(customer.schema)).write.saveAsTable(target)
    for name in ("csv", "json", "parquet"):
        shuffled.write.format(name).option("header", True).save(f"{stage}/{name}")
        for _ in range(2):  # the second load finds no new file
            load_into_table(spark, target, stage, name, name, scan_time=RUN_TS)
    prefix = F.split("metadata_filename", "/")[0].alias("prefix")
    return spark.table(target).select(prefix, *customer.columns, "metadata_ingest_time")


@query(
    "load_provenance",
    "SELECT 'orders.parquet' AS metadata_filename, TIMESTAMP '2024-02-01 06:00:00' AS metadata_ingest_time,"
    " count(*) AS n_rows FROM orders",
)
def load_provenance(spark: SparkSession, sf: str) -> DataFrame:
    schema = table(spark, sf, "orders").schema
    loaded = load_files(spark, sf, "orders.parquet", "parquet", schema, RUN_TS)
    return loaded.groupBy("metadata_filename", "metadata_ingest_time").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "load_files_once",
    "SELECT o_orderkey, o_orderstatus, o_totalprice, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS load_batch FROM orders",
)
def load_files_once(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    home = new_folder(spark, "once")
    loaded, history = f"{home}/table", f"{home}/history"

    def run() -> None:
        load_new_files(spark, home, "drops", "parquet", orders.schema, loaded, history, RUN_TS, files_per_batch=1)

    finished = F.col("o_orderstatus") == "F"
    orders.where(finished).repartition(3).write.parquet(f"{home}/drops")
    run()
    run()  # nothing new: no rows, no batch
    orders.where(~finished).repartition(3).write.mode("append").parquet(f"{home}/drops")
    run()
    # three files, three micro-batches a run
    return spark.read.parquet(loaded).select(*orders.columns, F.floor(F.col(BATCH) / 3).cast("int").alias(BATCH))


@query("load_with_history", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def load_with_history_query(spark: SparkSession, sf: str) -> DataFrame:
    """Files in three drops and a run with nothing new; the history keeps each from being loaded twice."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    home, target = new_folder(spark, "history"), f"{new_database(spark, 'history')}.orders"
    spark.createDataFrame([], with_provenance(orders.schema)).write.saveAsTable(target)
    for status in ("F", "O", "P", None):
        if status:
            orders.where(F.col("o_orderstatus") == status).repartition(2).write.mode("append").parquet(f"{home}/drops")
        load_with_history(spark, target, home, "drops", "parquet", f"{home}/files", RUN_TS, files_per_batch=1)
    return spark.table(target).select(*orders.columns)


@query(
    "json_record_landing",
    "SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(props->>'$.k' AS BIGINT) END AS k,"
    " CASE WHEN event_type <> 'error' THEN TIMESTAMP '2024-02-01 06:00:00' END AS scrape_ts, event_type = 'error' AS refused FROM events",
)
def json_record_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads of error events are cut off: refused, never lost."""
    events = table(spark, sf, "events")
    whole = F.concat(F.lit("["), "props", F.lit("]"))
    cut = F.when(F.col("event_type") == "error", F.substr(whole, F.lit(1), F.length(whole) - 2)).otherwise(whole)
    payloads = events.select("event_id", cut.alias("payload"))
    record = T.StructType([T.StructField("k", T.LongType())])
    return landed_and_refused(payloads, "payload", record, ntz(RUN_TS), ["event_id"]).withColumn("refused", F.col("refused").isNotNull())


@query("read_or_empty", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def read_or_empty(spark: SparkSession, sf: str) -> DataFrame:
    wanted = "c_custkey bigint, c_name string, c_mktsegment string"
    schema = T.StructType.fromDDL(wanted)
    found = files.read_or_empty(spark, f"{sf}/customer.parquet", "parquet", schema)
    missing = files.read_or_empty(spark, f"{sf}/customer_of_tomorrow.parquet", "parquet", schema)
    return found.unionByName(missing)


@query(
    "append_rows",
    "WITH batch AS (SELECT s_suppkey AS id, s_acctbal AS value, TIMESTAMP '2024-02-01 06:00:00' AS created FROM supplier"
    " UNION ALL SELECT id, value, TIMESTAMP '2024-02-01 06:00:00' FROM (VALUES (1, 100.0), (2, 200.0), (3, 300.0)) v(id, value))"
    " SELECT * FROM batch UNION ALL SELECT * FROM batch",
)
def append_rows(spark: SparkSession, sf: str) -> DataFrame:
    target = f"{new_database(spark, 'append')}.rows_twice"
    inline = inline_rows(spark, [(1, 100.0), (2, 200.0), (3, 300.0)], "id long, value double", RUN_TS)
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("value"), ntz(RUN_TS).alias("created")
    )
    batch = suppliers.unionByName(inline)
    append_to_table(batch, target)
    append_to_table(batch, target)
    return spark.table(target)


@query(
    "catalog_columns",
    " UNION ALL ".join(
        f"SELECT '{t.upper()}' AS table_name, '{c.upper()}' AS column_name, {i} AS ordinal, count({c}) AS n_values FROM {t}"
        for t in SCHEMAS
        for i, (c, _) in enumerate(columns(t), start=1)
    ),
)
def catalog_columns(spark: SparkSession, sf: str) -> DataFrame:
    database = new_database(spark, "listed")
    for name in SCHEMAS:
        spark.sql(f"CREATE TABLE {database}.{name} USING parquet LOCATION '{sf}/{name}.parquet'")
    names = [row["table_name"] for row in catalog.list_tables(spark, database).collect()]
    counts = catalog.value_counts({n: spark.table(f"{database}.{n}") for n in names}).select(
        F.upper("table_name").alias("table_name"), F.upper("column_name").alias("column_name"), "n_values"
    )
    listed = catalog.list_columns(spark, [f"{database}.{n}" for n in names])
    return listed.join(counts, ["table_name", "column_name"]).select("table_name", "column_name", "ordinal", "n_values")


def _object_text(name: str) -> str:
    parts = [
        f"""'{{"order_id":{i},"column_name":"{c}","type":"{t}","nullable":' || (count({c}) < count(*)) || '}}'"""
        for i, (c, t) in enumerate(columns(name), start=1)
    ]
    return f"SELECT '{name}' AS table_name, '[' || " + " || ',' || ".join(parts) + f" || ']' AS objects FROM {name}"


@query("schema_as_objects", " UNION ALL ".join(_object_text(t) for t in SCHEMAS))
def schema_as_objects(spark: SparkSession, sf: str) -> DataFrame:
    described = catalog.describe_frames({name: table(spark, sf, name) for name in SCHEMAS})
    return catalog.rows_to_objects(described, ["table_name"], "order_id")
