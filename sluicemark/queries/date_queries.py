"""Queries over day rows, uneven intervals, slices and backfills."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicemark.functions import dates
from sluicemark.functions.intervals import interval_calendar as build_calendar
from sluicemark.operators import intervals
from sluicemark.operators.export import append_to_table
from sluicemark.plans import flows
from sluicemark.plans.loads import backfill_late_files
from sluicemark.queries.registry import query, table
from sluicemark.session import new_database, new_folder
from sluicemark.sources.database import FULL, INCREMENTAL

_CALENDAR = """
SELECT start, "end" FROM (
  SELECT d + INTERVAL 6 HOUR AS start, d + INTERVAL 16 HOUR + INTERVAL 30 MINUTE AS "end", latest FROM days
  UNION ALL
  SELECT d + INTERVAL 16 HOUR + INTERVAL 30 MINUTE, d + INTERVAL 30 HOUR, latest FROM days)
WHERE start <= latest"""
_DAYS = """
b AS (SELECT min(ts) AS first, max(ts) AS latest FROM events),
days AS (SELECT unnest(generate_series(date_trunc('day', first)::TIMESTAMP, date_trunc('day', latest)::TIMESTAMP, INTERVAL 1 DAY)) AS d, latest FROM b)"""


def _calendar(spark: SparkSession, sf: str) -> DataFrame:
    bounds = table(spark, sf, "events").agg(F.min("ts").alias("first"), F.max("ts").alias("latest"))
    return build_calendar(bounds, "first", "latest")


@query("interval_calendar", f"WITH {_DAYS} {_CALENDAR}")
def interval_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return _calendar(spark, sf)


_INTERVAL_JOIN = f"""WITH {_DAYS}, cal AS ({_CALENDAR})
SELECT event_id, user_id, ts, start, "end" FROM events JOIN cal ON ts >= start AND ts < "end" """


@query("interval_join", _INTERVAL_JOIN)
def interval_join(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return intervals.interval_join(events, "ts", _calendar(spark, sf))


@query("interval_join_salted", _INTERVAL_JOIN)
def interval_join_salted(spark: SparkSession, sf: str) -> DataFrame:
    """The same with a calendar too large to broadcast."""
    events = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return intervals.interval_join(events, "ts", _calendar(spark, sf), broadcast_limit=0)


_LONG_INTERVALS = """SELECT n_nationkey, TIMESTAMP '2021-01-01 05:30:00' + INTERVAL 1 HOUR * (n_nationkey * 997) AS start,
 TIMESTAMP '2021-01-01 05:30:00' + INTERVAL 1 HOUR * (n_nationkey * 997 + 25800 + n_nationkey * 13) AS "end" FROM nation"""


_LATE = "(event_type = 'purchase' AND ts < TIMESTAMP '2024-01-06')"


@query(
    "backfill_late_rows",
    f"""SELECT CAST(ts AS DATE) AS run_date, count(*) AS n_rows, count(DISTINCT user_id) AS n_users, bool_or({_LATE}) AS rewritten
 FROM events GROUP BY 1""",
)
def backfill_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Purchases of the first days come a run late; only the days they belong to are written again."""
    events, home = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type"), new_folder(spark, "late")
    written = f"{home}/days"
    for rows in (events.where(f"NOT {_LATE}"), events.where(_LATE)):
        rows.write.mode("append").parquet(f"{home}/drops")
        days = backfill_late_files(spark, home, "drops", "parquet", events.schema, "ts", written, f"{home}/known")
    per_day = spark.read.parquet(written).groupBy("run_date").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("user_id").alias("n_users"))
    return per_day.withColumn("rewritten", F.col("run_date").isin(days))


@query("interval_join_years", f"""WITH cal AS ({_LONG_INTERVALS}) SELECT event_id, ts, n_nationkey, start, "end" FROM events JOIN cal ON ts >= start AND ts < "end" """)
def interval_join_years(spark: SparkSession, sf: str) -> DataFrame:
    """Intervals of about three years: 38 rows at most for each, not a thousand."""
    begun = F.col("n_nationkey") * 997
    since = lambda hours: F.lit("2021-01-01 05:30:00").cast("timestamp_ntz") + F.make_dt_interval(hours=hours)
    calendar = table(spark, sf, "nation").select("n_nationkey", since(begun).alias("start"), since(begun + 25800 + F.col("n_nationkey") * 13).alias("end"))
    return intervals.long_interval_join(table(spark, sf, "events").select("event_id", "ts"), "ts", calendar)


@query(
    "uneven_interval_agg",
    """WITH e AS (SELECT value, date_trunc('minute', ts) AS m, date_trunc('day', ts)::TIMESTAMP AS d FROM events)
SELECT CASE WHEN m BETWEEN d + INTERVAL 6 HOUR AND d + INTERVAL 990 MINUTE THEN d - INTERVAL 450 MINUTE
            WHEN m >= d + INTERVAL 990 MINUTE THEN d + INTERVAL 6 HOUR ELSE d - INTERVAL 18 HOUR END AS start,
       CASE WHEN m BETWEEN d + INTERVAL 6 HOUR AND d + INTERVAL 990 MINUTE THEN d + INTERVAL 6 HOUR
            WHEN m >= d + INTERVAL 990 MINUTE THEN d + INTERVAL 990 MINUTE ELSE d - INTERVAL 450 MINUTE END AS "end",
       count(*) AS n_rows, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM e GROUP BY ALL""",
)
def uneven_interval_agg(spark: SparkSession, sf: str) -> DataFrame:
    total = F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total")
    return intervals.aggregate_by_interval(table(spark, sf, "events"), "ts", F.count(F.lit(1)).alias("n_rows"), total)


@query(
    "date_range_rows",
    "WITH b AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders),"
    " days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS run_date FROM b)"
    " SELECT strftime(run_date, '%Y-%m-%d') AS run_date, count(o_orderkey) AS n_orders FROM days LEFT JOIN orders ON CAST(o_orderdate AS DATE) = days.run_date GROUP BY 1",
)
def date_range_rows(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    text = orders.agg(F.min(dates.dashed_day(F.col("o_orderdate"))).alias("lo"), F.max(dates.dashed_day(F.col("o_orderdate"))).alias("hi"))
    bounds = text.select(dates.parse_day(F.col("lo")).alias("first"), dates.parse_day(F.col("hi")).alias("last"))
    per_day = orders.groupBy(dates.day_of(F.col("o_orderdate")).alias("run_date")).agg(F.count("o_orderkey").alias("n_orders"))
    days = dates.explode_days(bounds, "first", "last").select("run_date")
    return days.join(per_day, "run_date", "left").select(
        dates.dashed_day(F.col("run_date")).alias("run_date"), F.coalesce("n_orders", F.lit(0)).alias("n_orders")
    )


@query(
    "descending_day_rows",
    "WITH b AS (SELECT CAST(min(ts) AS DATE) AS lo, CAST(max(ts) AS DATE) AS hi FROM events)"
    " SELECT strftime(unnest(generate_series(hi, lo, INTERVAL (-1) DAY)), '%Y-%m-%d') AS run_date, 'loop' AS origin FROM b"
    " UNION ALL SELECT '1997-01-15', 'fixed'",
)
def descending_day_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Day rows from the last event day down to the first, appended after one fixed row."""
    target = f"{new_database(spark, 'days')}.run_dates"
    day = dates.day_of(F.col("ts"))
    bounds = table(spark, sf, "events").agg(F.max(day).alias("last"), F.min(day).alias("first"))
    fixed = spark.range(1).select(F.lit("1997-01-15").cast("date").alias("run_date"), F.lit("fixed").alias("origin"))
    append_to_table(fixed, target)
    append_to_table(dates.explode_days_descending(bounds, "last", "first").select("run_date", F.lit("loop").alias("origin")), target)
    return spark.table(target).select(dates.dashed_day(F.col("run_date")).alias("run_date"), "origin")


_SLICED = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}


@query(
    "table_day_slices",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, strftime(hi - back::INTEGER, '%Y%m%d') AS start_date, strftime(hi - back::INTEGER, '%Y%m%d') AS end_date,"
        f" (SELECT count(*) FROM {t} WHERE CAST({c} AS DATE) = hi - back::INTEGER) AS n_rows"
        f" FROM (SELECT CAST(max({c}) AS DATE) AS hi FROM {t}), (VALUES (2), (1)) v(back)"
        for t, c in _SLICED.items()
    ),
)
def table_day_slices(spark: SparkSession, sf: str) -> DataFrame:
    frames = {t: (table(spark, sf, t), c) for t, c in _SLICED.items()}
    starts = {t: df.agg(F.to_date(F.max(c))).first()[0] for t, (df, c) in frames.items()}
    return flows.day_slices(frames, starts)


@query(
    "run_type_load",
    " UNION ALL ".join(
        f"SELECT 'backfill' AS run_type, '{t}' AS table_name, 'done' AS status, count(*) AS rows_parsed, count(*) AS rows_loaded, count(*) AS rows_held FROM {t}"
        for t in ("orders", "customer", "supplier")
    )
    + " UNION ALL SELECT 'incremental' AS run_type, 'orders' AS table_name, 'done' AS status, 0, 0, count(*) FROM orders",
)
def run_type_load(spark: SparkSession, sf: str) -> DataFrame:
    """A full run loads every table; the incremental run after it finds no new file for the first one."""
    database = new_database(spark, "runs")
    loads = {f"{database}.{t}": (sf, f"{t}.parquet", "parquet") for t in ("orders", "customer", "supplier")}
    for name, (_, file, _) in loads.items():
        empty = spark.createDataFrame([], flows.with_provenance(table(spark, sf, file.removesuffix(".parquet")).schema))
        empty.write.saveAsTable(name)
    runs = [flows.run_tables(spark, loads, run_type) for run_type in (FULL, INCREMENTAL)]
    held = [
        spark.table(name).agg(F.count(F.lit(1)).alias("rows_held")).withColumn("table_name", F.lit(name.split(".")[-1])) for name in loads
    ]
    return reduce(DataFrame.unionByName, runs).drop("error").join(reduce(DataFrame.unionByName, held), "table_name")


@query(
    "backfill_by_day",
    "SELECT strftime(ts, '%Y-%m-%d') AS run_date, event_id, user_id, value FROM events WHERE ts::DATE < (SELECT max(ts)::DATE FROM events)",
)
def backfill_by_day(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "value", "ts")
    first, last = events.agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    folder = new_folder(spark, "backfill")
    kept = events.where(F.to_date("ts") < F.lit(last))
    for source in (events, kept):  # the rerun replaces the same days, and removes the one its source has lost
        flows.backfill_by_day(source, "ts", *flows.backfill_bounds(last + dt.timedelta(days=1), first), folder)
    return spark.read.parquet(folder).select(dates.dashed_day(F.col("run_date")).alias("run_date"), "event_id", "user_id", "value")
