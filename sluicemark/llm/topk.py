"""Exact top-k by inner product with a three-phase uniform threshold.

A vector's score is the sum of ``lists`` local scores, one per run of its components.

1. Every block gives each query's best local scores of each list; the rows they name are scored in full, and the
   k-th best score so far is a safe cutoff: the result cannot end below it.
2. The cutoffs go to every block with the queries, and each list returns the entries that reach an equal share of the cutoff.  A row whose
   score reaches the cutoff must do so in at least one list, so none is missed.
3. Rows whose known local scores plus the most that the other lists can add stay below the cutoff are dropped.
   Those with all lists known have their score; the rest are scored in full.

Components are floor(``scale`` * x).  One that is no long, or a score that is none (that of a query with its own row included), is an error; nothing is rounded or cut.  Equal vectors are one row with
their k + 1 smallest ids, which is all that a result can hold of them.

Vectors that are null, empty or hold null or non-finite components take no part, nor do rows
whose id is null.  Only vectors of the query's own length are its candidates, and no row with
the query's id.  Repeated rows are candidates each; a query id is asked once.  Ties go to the smaller
id.  With fewer than k candidates all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicemark.llm.vectors import against, block_count, block_of, distinct_vectors, finite, stacked
from sluicemark.session import staged

BLOCK_ROWS = 4096
QUERY_ROWS = 2048
LISTS = 2
SCALE = 256
LARGEST = float(1 << 62)
# Below this size of components, products of up to 512 of them are exact in double precision.
_EXACT = 1 << 22


def _quantised(df: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    rows = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("x"))
    large = F.raise_error(F.lit("a component is too large for a whole score")).cast("long")
    whole = F.transform("x", lambda x: F.when(F.abs(x * scale) < LARGEST, F.floor(x * scale).cast("long")).otherwise(large))
    return rows.filter(F.col("id").isNotNull() & finite(F.col("x"))).select("id", whole.alias("v"))


def _products(queries: pd.Series, rows: pd.Series) -> np.ndarray:
    q, x = stacked(queries, np.int64), stacked(rows, np.int64)
    most_q, most_x = int(np.abs(q).max(initial=0)), int(np.abs(x).max(initial=0))
    if max(most_q, most_x) < _EXACT and q.shape[1] <= 512:
        return (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    if most_q * most_x * q.shape[1] < 1 << 63:
        return q @ x.T
    # Whole numbers of any size; an entry that is no long raises.
    return (q.astype(object) @ x.T.astype(object)).astype(np.int64)


def _sliced(df: DataFrame, lists: int) -> DataFrame:
    """A row per list, with that list's components as ``part``; short vectors may leave lists empty."""
    width = F.ceil(F.size("v") / lists).cast("int")
    cut = df.select("*", F.size("v").alias("dim"), F.explode(F.sequence(F.lit(0), F.lit(lists - 1))).alias("list"))
    return cut.withColumn("part", F.slice("v", F.col("list") * width + 1, width)).drop("v")


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0).cast("long"), lambda s, x: s + x)


def search(
    df: DataFrame,
    is_query: Column,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    lists: int = LISTS,
    scale: int = SCALE,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest scores of each query."""
    nodes = distinct_vectors(_quantised(df, vec_id, vector, scale), k + 1)
    nodes = nodes.select(F.xxhash64("v").alias("node"), F.col("ids")[0].alias("first"), "v", "ids")
    queries = staged(_quantised(df.filter(is_query), vec_id, vector, scale).groupBy("id").agg(F.min("v").alias("v")))
    n_blocks, q_blocks = block_count(nodes, block_rows), block_count(queries, query_rows)
    rows = _sliced(nodes.select("node", "first", "v", block_of(F.col("first"), n_blocks).alias("t_block")), lists)
    asked = _sliced(queries.select(F.col("id").alias("query_id"), "v", block_of(F.col("id"), q_blocks).alias("q_block")), lists)
    keys, entry = ["dim", "list"], "query_id long, list int, node long, first long, local long"

    def gathered(rows: pd.DataFrame, asked: pd.DataFrame, chosen: list[tuple[np.ndarray, np.ndarray]], local: np.ndarray) -> pd.DataFrame:
        q = np.concatenate([np.full(len(c), i) for i, c in chosen] or [np.zeros(0)]).astype(int)
        n = np.concatenate([c for _, c in chosen] or [np.zeros(0)]).astype(int)
        named = {"query_id": asked["query_id"].to_numpy()[q], "list": asked["list"].to_numpy()[q]}
        return pd.DataFrame(named | {c: rows[c].to_numpy()[n] for c in ("node", "first")} | {"local": local[q, n]})

    def best(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asked):
            return pd.DataFrame(columns=["query_id", "list", "node", "first", "local"])
        local = _products(asked["part"], rows["part"])
        few = min(k + 1, local.shape[1])
        return gathered(rows, asked, list(enumerate(np.argpartition(-local, few - 1, axis=1)[:, :few])), local)

    def reaching(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asked):
            return pd.DataFrame(columns=["query_id", "list", "node", "first", "local"])
        local = _products(asked["part"], rows["part"])
        share = asked["share"].to_numpy()
        return gathered(rows, asked, [(i, np.flatnonzero(local[i] >= share[i])) for i in range(len(asked))], local)

    def scored(pairs: DataFrame) -> DataFrame:
        """(query_id, vec_id, score) of (query_id, node, first), a row per id other than the query's."""
        full = pairs.join(nodes, ["node", "first"]).join(queries.select(F.col("id").alias("query_id"), F.col("v").alias("q")), "query_id")
        return full.select("query_id", F.explode("ids").alias("vec_id"), _dot("q", "v").alias("score")).filter(F.col("vec_id") != F.col("query_id"))

    def top(hits: DataFrame, by: list[str], score: str, n: int) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(score), "vec_id"))
        return hits.withColumn("rank", rank).filter(F.col("rank") <= n)

    # phase 1
    local = against(rows, asked, n_blocks, q_blocks, keys, best, entry).withColumn("vec_id", F.col("first"))
    named = top(local, ["query_id", "list"], "local", k + 1).select("query_id", "node", "first").distinct()
    cutoffs = top(scored(named), ["query_id"], "score", k).groupBy("query_id").agg(F.min("score").alias("cutoff"), F.count(F.lit(1)).alias("n"))
    cutoffs = staged(cutoffs.filter(F.col("n") >= k).select("query_id", "cutoff"))
    # phase 2; a query with fewer than k rows so far has no cutoff and takes everything
    none = F.lit(-(1 << 63)).cast("long")
    share = F.coalesce(F.ceil(F.col("cutoff") / lists), none)
    entries = against(rows, asked.join(cutoffs, "query_id", "left").withColumn("share", share).drop("cutoff"), n_blocks, q_blocks, keys, reaching, entry)
    # phase 3
    known = entries.groupBy("query_id", "node", "first").agg(F.sum("local").alias("known"), F.count(F.lit(1)).alias("n"))
    most = F.col("known") + (lists - F.col("n")) * (F.ceil(F.col("cutoff") / lists) - 1)
    left = staged(known.join(cutoffs, "query_id", "left").filter(F.col("cutoff").isNull() | (most >= F.col("cutoff"))))
    open_ = scored(left.filter(F.col("n") < lists).select("query_id", "node", "first"))
    done = left.filter(F.col("n") == lists).join(nodes.drop("v"), ["node", "first"]).select("query_id", F.explode("ids").alias("vec_id"), F.col("known").alias("score"))
    hits = open_.unionByName(done.filter(F.col("vec_id") != F.col("query_id")))
    return top(hits, ["query_id"], "score", k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT vec_id, len(e) AS dim, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM v
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
  FROM parts q JOIN parts c ON q.i = c.i AND q.dim = c.dim AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY ALL
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scores QUALIFY rank <= 5
"""
