"""Queries over filters, projections, scalar functions and checks."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicemark.functions.dates import ntz
from sluicemark.functions.paths import as_directory, chunk_path, comma_list, feed_path, format_token
from sluicemark.operators import checks, reports, selection
from sluicemark.operators.dedup import above_watermark
from sluicemark.operators.export import route_by_slot
from sluicemark.queries.registry import query, table
from sluicemark.queries.schema_list import SCHEMAS
from sluicemark.session import new_folder
from sluicemark.sources.files import CSV
from sluicemark.sources.loading import parse_files

SQL = Path(__file__).parent / "sql"


@query(
    "watermark_filter",
    "SELECT 'orders' AS target, l_orderkey, l_linenumber, l_shipdate FROM lineitem"
    " WHERE l_shipdate > (SELECT coalesce(max(o_orderdate), TIMESTAMP '1900-01-01') FROM orders)"
    " UNION ALL SELECT 'empty' AS target, l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE l_shipdate > TIMESTAMP '1900-01-01'",
)
def watermark_filter(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = table(spark, sf, "orders").select(F.col("o_orderdate").alias("l_shipdate"))
    empty = spark.createDataFrame([], orders.schema)
    return reduce(
        DataFrame.unionByName,
        [above_watermark(lines, t, "l_shipdate").withColumn("target", F.lit(n)) for n, t in (("orders", orders), ("empty", empty))],
    )


_RANGE = (
    "SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem WHERE CAST(l_shipdate AS DATE) >= DATE '1997-01-01'"
    " AND CAST(l_shipdate AS DATE) < DATE '1998-01-01' AND l_quantity IN (10, 11, 12)"
)


@query("param_range_inlist", _RANGE)
def param_range_inlist(spark: SparkSession, sf: str) -> DataFrame:
    """The range and list as a SQL file with bound parameters."""
    params = {"start_date": dt.date(1997, 1, 1), "end_date": dt.date(1998, 1, 1), "ids": selection.comma_values("10, 11, 12", float)}
    return selection.run_sql_file(spark, SQL / "range_and_list.sql", params, facts=table(spark, sf, "lineitem"))


@query("range_inlist_columns", _RANGE)
def range_inlist_columns(spark: SparkSession, sf: str) -> DataFrame:
    """The same as column filters: both the range and the list are pushed into the scan."""
    lines = selection.in_date_range(table(spark, sf, "lineitem"), "l_shipdate", dt.date(1997, 1, 1), dt.date(1998, 1, 1))
    return selection.in_comma_list(lines, "l_quantity", "10, 11, 12").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")


@query(
    "list_membership",
    "SELECT p_partkey, p_size || ', ' || (p_size + 1) || ' , 40' AS ids, 12 IN (p_size, p_size + 1, 40) AS has_12, 2 * p_size + 41 AS total FROM part",
)
def list_membership(spark: SparkSession, sf: str) -> DataFrame:
    """Typed lists from comma-separated text held in rows."""
    ids = comma_list(F.col("ids"), "int")
    text = F.format_string("%d, %d , 40", F.col("p_size"), F.col("p_size") + 1)
    return table(spark, sf, "part").select("p_partkey", text.alias("ids")).select(
        "p_partkey", "ids", F.array_contains(ids, 12).alias("has_12"), F.reduce(ids, F.lit(0), lambda a, b: a + b).alias("total")
    )


@query(
    "select_by_pattern",
    "SELECT l_orderkey, l_partkey, l_shipdate, 'lineitem' AS stream FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-03-01'",
)
def select_by_pattern(spark: SparkSession, sf: str) -> DataFrame:
    lines = selection.from_start(table(spark, sf, "lineitem"), "l_shipdate", ntz("1998-03-01 00:00:00"))
    chosen = selection.select_by_pattern(lines, ["lineitem.l_*key", "lineitem.l_shipdate", "!*.*_suppkey"], "lineitem")
    return selection.add_constant(chosen, "stream", F.lit("lineitem"))


@query(
    "classify_paths",
    "WITH p AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, 'landing/' || o_orderkey || CASE o_orderstatus WHEN 'F' THEN '.csv'"
    " WHEN 'O' THEN '.parquet' WHEN 'P' THEN '.json' ELSE '.txt' END AS path FROM orders)"
    " SELECT o_orderkey, path, CASE WHEN ends_with(path, '.csv') THEN 'csv_format' WHEN ends_with(path, '.parquet') THEN 'parquet_format'"
    " WHEN ends_with(path, '.json') THEN 'json_format' END AS token, path || '/' AS folder, path || '/' AS same_folder,"
    " 'rest_api_scrapes/orders/orders-' || strftime(d, '%Y-%m-%d') AS feed_path,"
    " 'exports/orders-' || strftime(d, '%Y-%m-%d') || '-chunk-1' AS chunk_path FROM p",
)
def classify_paths(spark: SparkSession, sf: str) -> DataFrame:
    status = F.col("o_orderstatus")
    suffix = F.when(status == "F", ".csv").when(status == "O", ".parquet").when(status == "P", ".json").otherwise(".txt")
    path, day = F.col("path"), F.to_date("o_orderdate")
    return (
        table(spark, sf, "orders")
        .withColumn("path", F.concat(F.lit("landing/"), F.col("o_orderkey").cast("string"), suffix))
        .select(
            "o_orderkey",
            "path",
            format_token(path).alias("token"),
            as_directory(path).alias("folder"),
            as_directory(as_directory(path)).alias("same_folder"),
            feed_path(F.lit("orders"), day).alias("feed_path"),
            chunk_path(F.lit("exports"), F.lit("orders"), day, F.lit(1)).alias("chunk_path"),
        )
    )


@query(
    "time_slot_routing",
    "SELECT CASE hour(ts) WHEN 12 THEN 'morning' WHEN 16 THEN 'afternoon' WHEN 20 THEN 'evening' ELSE 'manual' END AS slot,"
    " count(*) AS n_rows, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1",
)
def time_slot_routing(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "slots")
    route_by_slot(table(spark, sf, "events").select("event_id", "value", "ts"), "ts", folder)
    total = F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total")
    return spark.read.parquet(folder).groupBy("slot").agg(F.count(F.lit(1)).alias("n_rows"), total)


@query(
    "row_count_check",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, CAST(100 AS BIGINT) AS threshold, count(*) > 100 AS passed FROM {t}" for t in SCHEMAS
    ),
)
def row_count_check(spark: SparkSession, sf: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [checks.row_count(table(spark, sf, t), t, 100) for t in SCHEMAS])


# The value of an event whose k is 90 or more is spoilt in the csv files.
_REPORT = (
    "SELECT 'event_type=' || event_type AS file, count(*) AS rows_parsed, count(*) - count(*) FILTER (k >= 90) AS rows_loaded,"
    " count(*) FILTER (k >= 90) AS error_seen FROM (SELECT event_type, CAST(props->>'$.k' AS BIGINT) AS k FROM events) GROUP BY 1"
)


def _event_files_report(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    spoilt = F.when(k >= 90, F.concat(F.lit("?"), F.col("value").cast("string"))).otherwise(F.col("value").cast("string"))
    stage = new_folder(spark, "report")
    (
        table(spark, sf, "events")
        .select("event_id", "user_id", spoilt.alias("value"), "event_type")
        .hint("rebalance", "event_type")
        .write.partitionBy("event_type").option("header", True).csv(f"{stage}/events")
    )
    schema = T.StructType.fromDDL("event_id bigint, user_id bigint, value double")
    return reports.load_report(parse_files(spark, stage, "events", "csv", schema), header_lines=1)


def _per_event_type(report: DataFrame) -> DataFrame:
    """Report rows summed over the files of a folder, since Spark decides how many files it writes."""
    return report.groupBy(F.split("file", "/")[1].alias("file")).agg(
        F.sum("rows_parsed").alias("rows_parsed"), F.sum("rows_loaded").alias("rows_loaded"), F.sum("error_seen").alias("error_seen"),
        F.max("status").alias("status_low"), F.min("status").alias("status"), F.max("first_error_column_name").alias("first_error_column_name"),
    )


@query(
    "load_report",
    f"SELECT file, CASE WHEN error_seen > 0 THEN 'ERROR' ELSE 'LOADED' END AS status, rows_parsed, rows_loaded, error_seen,"
    f" CASE WHEN error_seen > 0 THEN 'value' END AS first_error_column_name FROM ({_REPORT})",
)
def load_report(spark: SparkSession, sf: str) -> DataFrame:
    return _per_event_type(_event_files_report(spark, sf)).drop("status_low")


@query(
    "load_error_positions",
    """WITH r AS (SELECT o_orderkey || ',"' || o_orderpriority || ', ""' || o_orderstatus || repeat('"', 3) AS head FROM orders WHERE o_orderstatus = 'P')
 SELECT 'csv' AS kind, head || ',n/a,' || 'x' AS record, 'o_totalprice' AS column_name, length(head) + 2 AS error_character FROM r
 UNION ALL SELECT 'json', '{"o_orderkey":' || o_orderkey || ',"note":"\\"o_totalprice\\": ' || o_orderpriority || '","o_totalprice":"n/a","tail":"x"}', 'o_totalprice',
 length('{"o_orderkey":' || o_orderkey || ',"note":"\\"o_totalprice\\": ' || o_orderpriority || '","o_totalprice":"n/a"') - 4 FROM orders WHERE o_orderstatus = 'P'""",
)
def load_error_positions(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in process have no price: refused, with the place of the field behind quoted separators and misleading texts."""
    orders, stage = table(spark, sf, "orders"), new_folder(spark, "positions")
    price = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice")
    quoted = F.concat("o_orderpriority", F.lit(', "'), "o_orderstatus", F.lit('"')).alias("note")
    orders.select("o_orderkey", quoted, price, F.lit("x").alias("tail")).write.options(**CSV.written()).csv(f"{stage}/csv")
    tricky = F.to_json(F.struct("o_orderkey", F.concat(F.lit('"o_totalprice": '), "o_orderpriority").alias("note")))
    number = F.when(F.col("o_orderstatus") == "P", '"n/a"').otherwise(F.col("o_totalprice").cast("string"))
    cut = F.substr(tricky, F.lit(1), F.length(tricky) - 1)
    orders.select(F.concat(cut, F.lit(',"o_totalprice":'), number, F.lit(',"tail":"x"}'))).write.text(f"{stage}/json")
    schema = T.StructType.fromDDL("o_orderkey long, note string, o_totalprice double, tail string")
    found = [reports.error_positions(parse_files(spark, stage, kind, kind, schema)).withColumn("kind", F.lit(kind)) for kind in ("csv", "json")]
    return found[0].unionByName(found[1]).drop("file")


@query(
    "load_summary",
    f"SELECT count(*) AS total_files, sum(rows_parsed)::BIGINT AS total_rows_parsed, sum(rows_loaded)::BIGINT AS total_rows_loaded,"
    f" sum(error_seen)::BIGINT AS total_errors_seen, string_agg(file, ',' ORDER BY file) FILTER (error_seen > 0) AS files_with_errors FROM ({_REPORT})",
)
def load_summary(spark: SparkSession, sf: str) -> DataFrame:
    summary = reports.load_summary(_per_event_type(_event_files_report(spark, sf)))
    return summary.withColumn("files_with_errors", F.concat_ws(",", "files_with_errors"))


_RULES = {
    "customer": [
        checks.Rule("c_custkey", required=True, minimum=0),
        checks.Rule("c_name", required=True, min_length=10, max_length=18),
        checks.Rule("c_acctbal", minimum=64, maximum=5000),
        checks.Rule("c_mktsegment", one_of=("BUILDING", "MACHINERY")),
    ],
    "part": [
        checks.Rule("p_name", min_length=10, max_length=20),
        checks.Rule("p_size", required=True, minimum=5, maximum=40),
        checks.Rule("p_type", constant="ECONOMY"),
    ],
    "events": [
        checks.Rule("user_id", required=True),
        checks.Rule("event_type", one_of=("view", "click", "signup", "purchase")),
        checks.Rule("value", minimum=1, maximum=128),
        checks.Rule("day", text_format="date"),
        checks.Rule("at_time", text_format="date-time"),
        checks.Rule("props", text_format="date"),
        checks.Rule("clock", text_format="time"),
    ],
}


def _rule_sql(name: str, source: str) -> str:
    conditions = []
    for r in _RULES[name]:
        c = r.column
        if r.required:
            conditions.append((c, "required", f"{c} IS NULL"))
        if r.one_of:
            conditions.append((c, "one_of", f"{c} NOT IN ({', '.join(repr(v) for v in r.one_of)})"))
        if r.min_length is not None:
            conditions.append((c, "min_length", f"length({c}) < {r.min_length}"))
        if r.max_length is not None:
            conditions.append((c, "max_length", f"length({c}) > {r.max_length}"))
        if r.minimum is not None:
            conditions.append((c, "minimum", f"{c} < {r.minimum}"))
        if r.maximum is not None:
            conditions.append((c, "maximum", f"{c} > {r.maximum}"))
        if r.constant is not None:
            conditions.append((c, "constant", f"{c} <> {r.constant!r}"))
        if r.text_format == "date":
            conditions.append((c, "format", f"try_cast({c} AS DATE) IS NULL"))
        if r.text_format == "date-time":
            conditions.append((c, "format", f"try_cast({c} AS TIMESTAMP) IS NULL"))
        if r.text_format == "time":
            conditions.append((c, "format", f"NOT regexp_full_match({c}, '[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}')"))
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, '{kind}' AS rule, count(*) FILTER ({broken}) AS violations FROM {source}"
        for c, kind, broken in conditions
    )


@query(
    "row_constraints",
    " UNION ALL ".join(
        [
            _rule_sql("customer", "customer"),
            _rule_sql("part", "part"),
            _rule_sql("events", "(SELECT *, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at_time,"
                      " strftime(ts, '%H:%M:%S') || CASE WHEN event_type = 'error' THEN 'xyz' ELSE '' END AS clock FROM events)"),
        ]
    ),
)
def row_constraints(spark: SparkSession, sf: str) -> DataFrame:
    frames = {
        "customer": table(spark, sf, "customer"),
        "part": table(spark, sf, "part"),
        "events": table(spark, sf, "events").select(
            "*", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at_time"),
            F.concat(F.date_format("ts", "HH:mm:ss"), F.when(F.col("event_type") == "error", "xyz").otherwise("")).alias("clock"),
        ),
    }
    return reduce(DataFrame.unionByName, [checks.count_violations(df, _RULES[n], n) for n, df in frames.items()])
