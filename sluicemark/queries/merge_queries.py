"""Queries over dedup, upsert and the upsert flows.

The merge target is each order as its first line, ``(order, line 1)``; the batch is every line
item.  Both tables are read whole, and the merge has rows of all three kinds: updated (first
lines), inserted (further lines) and untouched (orders without a first line in the batch).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicemark.functions.dates import ntz
from sluicemark.operators.dedup import latest_per_key
from sluicemark.operators.merge import merge_metrics as count_merge
from sluicemark.operators.merge import heavy_keys, upsert
from sluicemark.plans import flows, snapshots
from sluicemark.queries.registry import query, table
from sluicemark.session import BROADCAST_LIMIT_BYTES, new_database, new_folder, staged_with_size

SCAN_TIME = dt.datetime(2024, 2, 1, 6, 0, 0)
KEYS = ["l_orderkey", "l_linenumber"]
# Real duplicates exist per key, so the order runs on until it is total.
LINE_ORDER = [
    "l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]
_RANK = f"row_number() OVER (PARTITION BY {', '.join(KEYS)} ORDER BY {', '.join(c + ' DESC NULLS LAST' for c in LINE_ORDER)})"
_LATEST = f"SELECT * FROM lineitem QUALIFY {_RANK} = 1"
_MERGED = (
    f"WITH s AS ({_LATEST}), t AS (SELECT o_orderkey AS l_orderkey, 1 AS l_linenumber, o_orderstatus AS l_linestatus,"
    " o_totalprice AS l_extendedprice, o_orderdate AS l_shipdate FROM orders)"
    " SELECT coalesce(t.l_orderkey, s.l_orderkey) AS l_orderkey, coalesce(t.l_linenumber, s.l_linenumber) AS l_linenumber,"
    " CASE WHEN s.l_orderkey IS NULL THEN t.l_linestatus ELSE s.l_linestatus END AS l_linestatus,"
    " CASE WHEN s.l_orderkey IS NULL THEN t.l_extendedprice ELSE s.l_extendedprice END AS l_extendedprice,"
    " CASE WHEN s.l_orderkey IS NULL THEN t.l_shipdate ELSE s.l_shipdate END AS l_shipdate{extra}"
    " FROM t FULL OUTER JOIN s ON t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber"
)


def first_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Each order as its line 1."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.lit(1).alias("l_linenumber"),
        F.col("o_orderstatus").alias("l_linestatus"),
        F.col("o_totalprice").alias("l_extendedprice"),
        F.col("o_orderdate").alias("l_shipdate"),
    )


@query("dedup_latest", "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1")
def dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    """The kept rows under a temporary name, as the upsert flow's dedup step leaves them."""
    latest = latest_per_key(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"])
    latest.createOrReplaceTempView("latest_events")
    return spark.table("latest_events")


@query("dedup_composite_key", _LATEST)
def dedup_composite_key(spark: SparkSession, sf: str) -> DataFrame:
    return latest_per_key(table(spark, sf, "lineitem"), KEYS, LINE_ORDER)


@query("upsert_merge", _MERGED.format(extra=""))
def upsert_merge(spark: SparkSession, sf: str) -> DataFrame:
    target = first_lines(spark, sf)
    latest, size = staged_with_size(latest_per_key(table(spark, sf, "lineitem"), KEYS, LINE_ORDER).select(*target.columns))
    return upsert(target, latest, KEYS, source_is_small=size <= BROADCAST_LIMIT_BYTES, source_is_unique=True)


_HOT = (
    "WITH t AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE o_custkey END AS id, o_orderpriority AS name, o_totalprice AS amount FROM orders),"
    " s AS (SELECT c_custkey AS id, c_name AS name, c_acctbal AS amount FROM customer UNION ALL SELECT -1, max(c_name), max(c_acctbal) FROM customer)"
)


@query(
    "upsert_hot_key",
    f"{_HOT} SELECT coalesce(t.id, s.id) AS id, CASE WHEN s.id IS NULL THEN t.name ELSE s.name END AS name,"
    " CASE WHEN s.id IS NULL THEN t.amount ELSE s.amount END AS amount FROM t FULL OUTER JOIN s ON t.id = s.id",
)
def upsert_hot_key(spark: SparkSession, sf: str) -> DataFrame:
    """A third of the target's rows have one key and the batch is taken as too large to broadcast."""
    key = F.when(F.col("o_orderkey") % 3 == 0, F.lit(-1)).otherwise(F.col("o_custkey"))
    target = table(spark, sf, "orders").select(key.cast("long").alias("id"), F.col("o_orderpriority").alias("name"), F.col("o_totalprice").alias("amount"))
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("amount"))
    whole = customer.agg(F.lit(-1).cast("long").alias("id"), F.max("name").alias("name"), F.max("amount").alias("amount"))
    batch, _ = staged_with_size(customer.unionByName(whole))
    return upsert(target, batch, ["id"], source_is_unique=True, heavy=heavy_keys(target, ["id"]))


@query(
    "merge_metrics",
    f"WITH s AS ({_LATEST}) SELECT count(*) FILTER (o_orderkey IS NULL) AS rows_inserted, count(o_orderkey) AS rows_updated"
    " FROM s LEFT JOIN orders ON o_orderkey = l_orderkey AND l_linenumber = 1",
)
def merge_metrics(spark: SparkSession, sf: str) -> DataFrame:
    batch = table(spark, sf, "lineitem").select(*KEYS).distinct()
    return count_merge(first_lines(spark, sf), batch, KEYS, source_is_unique=True)


@query(
    "upsert_from_files",
    _MERGED.format(
        extra=", CASE WHEN s.l_orderkey IS NULL THEN 'orders.parquet' ELSE 'lineitem.parquet' END AS metadata_filename,"
        " CASE WHEN s.l_orderkey IS NULL THEN TIMESTAMP '2023-12-31' ELSE TIMESTAMP '2024-02-01 06:00:00' END AS metadata_ingest_time"
    ),
)
def upsert_from_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files to target: load by name with provenance, watermark, dedup, merge."""
    target = first_lines(spark, sf).withColumns(
        {"metadata_filename": F.lit("orders.parquet"), "metadata_ingest_time": ntz("2023-12-31 00:00:00")}
    )
    # The target's own columns make the order total only where ties are whole copies of a row.
    order = ["l_shipdate", "l_extendedprice", "l_linestatus"]
    config = flows.TableConfig("order_lines", sf, "lineitem.parquet", KEYS, order, "metadata_ingest_time")
    return flows.upsert_files(spark, target, config, SCAN_TIME)


ROWS_PER_DROP = 1_000_000


def files_per_drop(rows: int, drops: int, rows_per_file: int = ROWS_PER_DROP) -> int:
    """Files of each of ``drops`` even drops, so that none is expected to hold more than ``rows_per_file`` rows."""
    return max(1, -(-rows // (drops * rows_per_file)))


@query("upsert_streamed", _MERGED.format(extra=""))
def upsert_streamed(spark: SparkSession, sf: str) -> DataFrame:
    """The same merge fed by the file stream in three micro-batches; the second run finds no new file and changes nothing.

    A micro-batch is one file while the table is small and more of them as it grows, since a file is one task's work.
    """
    stage = new_folder(spark, "drops")
    lines = table(spark, sf, "lineitem")
    files = files_per_drop(lines.count(), drops=3)
    # A key lies in one file: among files, the last one merged wins.
    lines.repartition(3 * files, "l_orderkey").write.parquet(f"{stage}/lineitem")
    target = f"{new_database(spark, 'streamed')}.order_lines"
    flows.create_target(
        first_lines(spark, sf).withColumns({"metadata_filename": F.lit("orders.parquet"), "metadata_ingest_time": ntz("2023-12-31 00:00:00")}),
        target,
    )
    order = ["l_shipdate", "l_extendedprice", "l_linestatus"]
    config = flows.TableConfig(target, stage, "lineitem", KEYS, order, "metadata_ingest_time")
    history = new_folder(spark, "history")
    for _ in range(2):
        flows.upsert_new_files(spark, config, history, SCAN_TIME, files_per_batch=files)
    return spark.table(target).drop("metadata_filename", "metadata_ingest_time")


@query("upsert_key_buckets", _MERGED.format(extra=""))
def upsert_key_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """The same merge into files partitioned by a bucket of the key; only touched buckets are rewritten."""
    folder, buckets = new_folder(spark, "buckets"), 16
    start = first_lines(spark, sf)
    flows.replace_partitions(flows.with_key_bucket(start, KEYS, buckets), folder, [flows.KEY_BUCKET])
    latest = latest_per_key(table(spark, sf, "lineitem"), KEYS, LINE_ORDER).select(*start.columns)
    flows.upsert_key_buckets(spark.read.parquet(folder), latest, KEYS, buckets, folder)
    return spark.read.parquet(folder).select(*start.columns)


_RECENT = "WITH recent AS (SELECT max(o_orderdate) - INTERVAL 60 DAY AS since FROM orders)"


@query(
    "upsert_touched_files",
    f"{_RECENT} SELECT o_orderdate, o_orderkey, CASE WHEN o_orderdate >= since THEN 'R' ELSE o_orderstatus END AS o_orderstatus, o_totalprice, true AS few_rewritten"
    " FROM orders, recent"
    " UNION ALL SELECT o_orderdate + INTERVAL 1000 DAY, o_orderkey, 'N', o_totalprice, true FROM orders, recent WHERE o_orderdate >= since",
)
def upsert_touched_files(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of the last 60 days come again, and once more with later dates; all other files of the table stay as they are."""
    orders = table(spark, sf, "orders").select("o_orderdate", "o_orderkey", "o_orderstatus", "o_totalprice")
    folder = new_folder(spark, "snapshots")
    snapshots.create_snapshot_table(orders, folder, ["o_orderdate", "o_orderkey"], rows_per_file=500)
    since = orders.agg((F.max("o_orderdate") - F.expr("interval 60 days")).alias("since"))
    recent = orders.where(F.col("o_orderdate") >= since.scalar())
    later = recent.withColumns({"o_orderdate": F.col("o_orderdate") + F.expr("interval 1000 days"), "o_orderstatus": F.lit("N")})
    done = snapshots.upsert_snapshot(folder, recent.withColumn("o_orderstatus", F.lit("R")).unionByName(later), rows_per_file=500)
    few = done["files_rewritten"] * 3 <= done["files_kept"]
    return snapshots.read_snapshot(spark, folder).withColumn("few_rewritten", F.lit(few))


_MANY = [
    # target key and date, the table that already holds some keys, the batch table and its key
    ("orders", "o_orderkey", "lineitem", "l_orderkey"),
    ("customer", "c_custkey", "orders", "o_custkey"),
    ("part", "p_partkey", "lineitem", "l_partkey"),
]


@query(
    "upsert_many_tables",
    " UNION ALL ".join(
        f"SELECT '{batch}' AS table_name, 'done' AS status, count(*) FILTER (k IS NULL) AS rows_inserted, count(k) AS rows_updated"
        f" FROM {batch} LEFT JOIN (SELECT DISTINCT {held_key} AS k FROM {held}) ON k = {key}"
        for batch, key, held, held_key in _MANY
    ),
)
def upsert_many_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Each target starts with the keys another table refers to; the batch is the whole table."""
    database = new_database(spark, "many")
    configs = []
    for batch, key, held, held_key in _MANY:
        columns = table(spark, sf, batch).columns
        known = table(spark, sf, held).select(F.col(held_key).alias(key)).distinct()
        kinds = {f.name: f.dataType for f in flows.with_provenance(table(spark, sf, batch).schema)}
        start = known.select(key, *[F.lit(None).cast(kind).alias(c) for c, kind in kinds.items() if c != key])
        flows.create_target(start, f"{database}.{batch}", [key])
        order = [c for c in columns if c != key]
        configs.append(flows.TableConfig(f"{database}.{batch}", sf, f"{batch}.parquet", [key], order, "metadata_ingest_time"))
    return flows.upsert_tables(spark, configs, SCAN_TIME).drop("error")


@query("build_then_load", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'supplier.parquet' AS metadata_filename,"
       " TIMESTAMP '2024-02-01 06:00:00' AS metadata_ingest_time FROM supplier")
def build_then_load(spark: SparkSession, sf: str) -> DataFrame:
    built = f"{new_database(spark, 'build')}.supplier"
    flows.build_then_load(spark, built, sf, "supplier.parquet", "parquet", scan_time=SCAN_TIME)
    return spark.table(built)
