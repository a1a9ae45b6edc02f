"""Approximate nearest neighbours: one navigable small-world graph per shard.

Distinct vectors are dealt to shards by hash.  Each shard builds a hierarchical graph whose
neighbours lie in flat arrays of fixed width, padded with -1: ``2 * m`` places on the ground level and ``m``
on each level above, one after the other.  The graphs are a table in the shared folder, a row per vector.  A search
takes blocks of queries to every shard, walks each shard's graph and merges the shards' results.

Shards have at most about ``shard_rows`` vectors, so building stays linear in the table and a task's memory bounded.
A shard of no more vectors than the search would hold anyway is searched by scanning it.

Vectors that are null, zero, empty or hold null or non-finite components take no part, nor do rows
whose id is null.  Only vectors of the query's own length are its candidates, and no row with
the query's id.  Repeated rows are candidates each; a query id is asked once.  Ties go to the smaller
id.  A query without candidates, and an empty table, give no rows.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicemark.llm.vectors import against, block_count, block_of, distinct_vectors, finite, stacked
from sluicemark.session import staged

SHARD_ROWS = 4096
QUERY_ROWS = 4096
M = 16
EF_BUILD = 80
EF_SEARCH = 160


class Graph:
    """A shard's vectors and their neighbours by level."""

    def __init__(self, vectors: np.ndarray, m: int = M):
        # Distances come as norms less products, so what all vectors have in common is taken off first.
        self.centre = vectors.mean(axis=0, dtype=np.float64)
        self.x = vectors - self.centre
        self.norms = np.einsum("ij,ij->i", self.x, self.x)
        self.m = m
        self.seen = np.zeros(len(vectors), dtype=np.int64)
        self.walks = 0
        draws = np.random.default_rng(len(vectors)).random(len(vectors))
        self.level = np.minimum(-np.log(1 - draws) / math.log(m), 30).astype(np.int32)
        self.links: list[np.ndarray] = []
        self.entry = -1

    def _distances(self, q: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        return self.norms[nodes] - 2 * (self.x[nodes] @ q)  # short of the query's own norm

    def walk(self, q: np.ndarray, starts: list[tuple[float, int]], ef: int, level: int) -> list[tuple[float, int]]:
        """Up to ``ef`` nearest (distance, node) reached from ``starts``, nearest first."""
        self.walks += 1
        seen, mark, links = self.seen, self.walks, self.links[level]
        near = list(starts)
        heapq.heapify(near)
        best = [(-d, n) for d, n in starts]
        heapq.heapify(best)
        for _, n in starts:
            seen[n] = mark
        while near:
            d, n = heapq.heappop(near)
            if len(best) >= ef and d > -best[0][0]:
                break
            around = links[n]
            around = around[around >= 0]
            around = around[seen[around] != mark]
            if not len(around):
                continue
            seen[around] = mark
            for d, n in zip(self._distances(q, around).tolist(), around.tolist(), strict=True):
                if len(best) < ef:
                    heapq.heappush(best, (-d, n))
                    heapq.heappush(near, (d, n))
                elif d < -best[0][0]:
                    heapq.heapreplace(best, (-d, n))
                    heapq.heappush(near, (d, n))
        return sorted((-d, n) for d, n in best)

    def descend(self, q: np.ndarray, to: int) -> list[tuple[float, int]]:
        at = [(float(self._distances(q, np.array([self.entry]))[0]), self.entry)]
        for level in range(len(self.links) - 1, to, -1):
            at = self.walk(q, at, 1, level)
        return at

    def _choose(self, dists: np.ndarray, nodes: np.ndarray, most: int) -> np.ndarray:
        """Neighbours in several directions: a node nearer to a chosen one than to the centre comes last."""
        order = np.argsort(dists, kind="stable")
        nodes = nodes[order]
        x = self.x[nodes]
        between = (self.norms[nodes][:, None] + self.norms[nodes][None, :] - 2 * (x @ x.T)).tolist()
        to_centre = dists[order].tolist()
        chosen: list[int] = []
        passed: list[int] = []
        for i, d in enumerate(to_centre):
            row = between[i]
            if all(row[j] > d for j in chosen):
                chosen.append(i)
                if len(chosen) == most:
                    break
            else:
                passed.append(i)
        return nodes[chosen + passed[: most - len(chosen)]]

    def _link(self, n: int, others: np.ndarray, level: int) -> None:
        links = self.links[level]
        links[n, : len(others)] = others
        for o in others.tolist():
            row = links[o]
            free = np.flatnonzero(row < 0)
            if len(free):
                row[free[0]] = n
            else:
                nodes = np.append(row, n)
                dists = self._distances(self.x[o], nodes) + self.norms[o]
                kept = self._choose(dists, nodes, len(row))
                row[:] = -1
                row[: len(kept)] = kept

    def build(self, ef: int = EF_BUILD) -> Graph:
        n_rows = len(self.x)
        for n in range(n_rows):
            q, top = self.x[n], int(self.level[n])
            if self.entry >= 0:
                at = self.descend(q, top) if top < len(self.links) else self.descend(q, len(self.links) - 1)
                for level in range(min(top, len(self.links) - 1), -1, -1):
                    at = self.walk(q, at, ef, level)
                    dists = np.array([d for d, _ in at]) + self.norms[n]
                    self._link(n, self._choose(dists, np.array([o for _, o in at]), self.m), level)
            if top >= len(self.links):
                while len(self.links) <= top:
                    self.links.append(np.full((n_rows, self.m * (1 if self.links else 2)), -1, dtype=np.int32))
                self.entry = n
        return self

    def flat(self) -> list[np.ndarray]:
        """Each node's neighbours of levels 0 to its own, one after the other."""
        return [np.concatenate([self.links[v][n] for v in range(self.level[n] + 1)]) for n in range(len(self.x))]

    @classmethod
    def of(cls, vectors: np.ndarray, flat: list[np.ndarray], m: int) -> Graph:
        graph = cls(vectors, m)
        graph.level = np.array([(len(f) - 2 * m) // m for f in flat], dtype=np.int32)
        for level in range(int(graph.level.max()) + 1):
            first, width = (0, 2 * m) if level == 0 else (m * (level + 1), m)
            links = np.full((len(flat), width), -1, dtype=np.int32)
            for n in np.flatnonzero(graph.level >= level).tolist():
                links[n] = flat[n][first : first + width]
            graph.links.append(links)
        graph.entry = int(np.flatnonzero(graph.level == graph.level.max())[0])
        return graph

    def nearest(self, q: np.ndarray, ef: int = EF_SEARCH) -> np.ndarray:
        q = q - self.centre
        return np.array([n for _, n in self.walk(q, self.descend(q, 0), ef, 0)])


def _valid(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    rows = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    return rows.filter(F.col("id").isNotNull() & finite(F.col("v")) & F.exists("v", lambda x: x != 0))


def build_index(df: DataFrame, vec_id: str, vector: str, copies: int, shard_rows: int = SHARD_ROWS, m: int = M, ef: int = EF_BUILD) -> tuple[DataFrame, int]:
    """The index, (dim, t_block, node, v, ids, links), and its number of shards."""
    nodes = distinct_vectors(_valid(df, vec_id, vector), copies)
    shards = block_count(nodes, shard_rows)
    dealt = nodes.select(F.size("v").alias("dim"), block_of(F.col("v"), shards).alias("t_block"), "v", "ids")

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.iloc[np.argsort([i[0] for i in rows["ids"]], kind="stable")].reset_index(drop=True)
        rows["node"] = np.arange(len(rows), dtype=np.int32)
        rows["links"] = Graph(stacked(rows["v"]), m).build(ef).flat()
        return rows[["dim", "t_block", "node", "v", "ids", "links"]]

    schema = "dim int, t_block int, node int, v array<double>, ids array<long>, links array<int>"
    # Shards are few and costly, so they are spread by their number and not put together by their size.
    spread = dealt.repartition(2 * shards, "dim", "t_block")
    return staged(spread.groupBy("dim", "t_block").applyInPandas(build, schema)), shards


def search(
    df: DataFrame,
    is_query: Column,
    k: int = 10,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
    m: int = M,
    ef_build: int = EF_BUILD,
    ef_search: int = EF_SEARCH,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found of each query, by Euclidean distance."""
    index, shards = build_index(df, vec_id, vector, k + 1, shard_rows, m, ef_build)
    queries = staged(_valid(df.filter(is_query), vec_id, vector).groupBy("id").agg(F.min("v").alias("v")))
    blocks = block_count(queries, query_rows)
    asked = queries.select("id", "v", F.size("v").alias("dim"), block_of(F.col("id"), blocks).alias("q_block"))
    width = max(ef_search, k + 1)

    def find(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, float]] = []
        if len(rows) and len(asked):
            rows = rows.sort_values("node")
            x, ids = stacked(rows["v"]), rows["ids"].to_list()
            graph = Graph.of(x, rows["links"].to_list(), m)
            for query, q in zip(asked["id"].to_list(), asked["v"].to_list(), strict=True):
                near = graph.nearest(q, width)
                exact = np.sqrt(np.square(x[near] - q).sum(axis=1))
                hits = [(d, int(i)) for d, n in zip(exact.tolist(), near.tolist(), strict=True) for i in ids[n] if i != query]
                found += [(query, i, d) for d, i in heapq.nsmallest(k, hits)]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    hits = against(index, asked, shards, blocks, ["dim"], find, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return hits.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
