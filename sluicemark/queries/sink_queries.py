"""Queries over sinks; what is written is read back and compared."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicemark.functions.dates import dashed_day, ntz
from sluicemark.operators.export import export_chunks, export_numbered_chunks, limit_rows, unload, write_skip_empty
from sluicemark.plans.flows import export_run, land_payloads, with_provenance
from sluicemark.queries.registry import query, table
from sluicemark.session import new_database, new_folder
from sluicemark.sources.database import FULL, INCREMENTAL
from sluicemark.sources.files import read_or_empty
from sluicemark.sources.loading import load_into_table

RUN_TS = dt.datetime(2024, 2, 1, 6, 0, 0)


@query("truncate_reload", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, 'part.parquet' AS metadata_filename FROM part")
def truncate_reload(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    target = f"{new_database(spark, 'reload')}.part"
    spark.createDataFrame([], with_provenance(part.schema)).write.saveAsTable(target)
    for _ in range(2):
        load_into_table(spark, target, sf, "part.parquet", "parquet", truncate=True, scan_time=RUN_TS)
    return spark.table(target).drop("metadata_ingest_time")


@query("unload_roundtrip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def unload_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with quotes and line breaks, out as csv and back."""
    documents = table(spark, sf, "documents")
    return read_or_empty(spark, unload(documents, new_folder(spark, "unload"), "csv"), "csv", documents.schema)


@query(
    "unload_limited",
    "SELECT 'top 100' AS rows_asked, p_partkey, p_retailprice FROM (SELECT * FROM part ORDER BY p_partkey LIMIT 100)"
    " UNION ALL SELECT 'top 1500' AS rows_asked, p_partkey, p_retailprice FROM (SELECT * FROM part ORDER BY p_partkey LIMIT 1500)"
    " UNION ALL SELECT 'all' AS rows_asked, p_partkey, p_retailprice FROM part",
)
def unload_limited(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    parts = []
    for asked, rows in (("top 100", 100), ("top 1500", 1500), ("all", 0)):
        ordered = part.repartitionByRange(8, "p_partkey").sortWithinPartitions("p_partkey") if not rows else part.orderBy("p_partkey")
        folder = unload(ordered, new_folder(spark, "limited"), "parquet", rows)
        parts.append(spark.read.schema(part.schema).parquet(folder).withColumn("rows_asked", F.lit(asked)))
    return reduce(DataFrame.unionByName, parts)


@query("unload_limited_wide", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem ORDER BY l_orderkey, l_linenumber, l_quantity LIMIT 20000")
def unload_limited_wide(spark: SparkSession, sf: str) -> DataFrame:
    """A limit beyond one task: partitions keep their share of the first rows."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    ordered = lines.repartitionByRange(8, "l_orderkey").sortWithinPartitions("l_orderkey", "l_linenumber", "l_quantity")
    first = limit_rows(ordered, 20_000, in_one_task=1_000)
    return spark.read.schema(lines.schema).parquet(unload(first, new_folder(spark, "limited"), "parquet"))


@query(
    "numbered_chunks",
    "WITH n AS (SELECT count(*) AS n FROM lineitem) SELECT 'lineitem-2024-02-01-chunk-' || c || '.parquet' AS file, least(10000, n - (c - 1) * 10000)::BIGINT AS n_rows"
    " FROM n, (SELECT unnest(range(1, (SELECT (n + 9999) // 10000 + 1 FROM n))) AS c)",
)
def numbered_chunks(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "numbered-chunks")
    export_numbered_chunks(table(spark, sf, "lineitem"), folder, "lineitem", RUN_TS.date())
    back = spark.read.parquet(folder)
    return back.groupBy(F.substring_index("_metadata.file_path", "/", -1).alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "write_skip_empty",
    "SELECT 'customer' AS written, count(*) AS n_rows FROM customer"
    " UNION ALL SELECT 'none' AS written, count(*) AS n_rows FROM customer WHERE c_custkey IS NULL",
)
def write_skip_empty_query(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    home = new_folder(spark, "skip")
    write_skip_empty(customer, f"{home}/customer")
    write_skip_empty(customer.where("c_custkey IS NULL"), f"{home}/none")
    found = [
        read_or_empty(spark, f"{home}/{name}.parquet", "parquet", customer.schema)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(name).alias("written"), "n_rows")
        for name in ("customer", "none")
    ]
    return found[0].unionByName(found[1])


@query("chunked_export", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, true AS within_chunk FROM orders")
def chunked_export(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "chunks")
    export_chunks(table(spark, sf, "orders"), folder)
    back = spark.read.parquet(folder)
    per_file = back.groupBy(F.col("_metadata.file_path").alias("file")).count()
    largest = per_file.agg(F.max("count").alias("n")).select(F.col("n") <= 10_000)
    return back.withColumn("within_chunk", largest.scalar())


@query(
    "incremental_export",
    "SELECT 'Incremental' AS run_type, o_orderkey, o_orderdate FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '2001-07-30'"
    " UNION ALL SELECT 'Full Backfill' AS run_type, o_orderkey, o_orderdate FROM orders",
)
def incremental_export(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    parts = []
    for run_type in (INCREMENTAL, FULL):
        folder = new_folder(spark, "export")
        export_run(orders, "o_orderdate", run_type, dt.date(2001, 7, 31), folder)
        parts.append(spark.read.schema(orders.schema).parquet(folder).withColumn("run_type", F.lit(run_type)))
    return parts[0].unionByName(parts[1])


@query(
    "feed_landing",
    "SELECT event_type AS feed, strftime(ts, '%Y-%m-%d') AS run_date, count(*) AS n_rows, sum(CAST(props->>'$.k' AS BIGINT))::BIGINT AS total_k,"
    " TIMESTAMP '2024-02-01 06:00:00' AS scrape_ts FROM events GROUP BY ALL",
)
def feed_landing(spark: SparkSession, sf: str) -> DataFrame:
    payloads = table(spark, sf, "events").select(
        F.col("event_type").alias("feed"), F.to_date("ts").alias("run_date"), F.concat(F.lit("["), "props", F.lit("]")).alias("payload")
    )
    record = T.StructType([T.StructField("k", T.LongType())])
    folder = new_folder(spark, "rest_api_scrapes")
    for _ in range(2):  # a rerun lands in the same partitions
        land_payloads(payloads, "payload", record, ntz(RUN_TS), folder)
    return spark.read.parquet(folder).groupBy("feed", dashed_day(F.col("run_date")).alias("run_date"), "scrape_ts").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("k").alias("total_k")
    )
