from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluicemark.llm import hnsw, topk

NAN, INF = float("nan"), float("inf")
ODD = [(100, [1.0, 2.0]), (101, [1.0, 2.0]), (101, [1.0, 2.0]), (102, None), (103, [0.0, 0.0]), (104, [NAN, 1.0]), (105, [INF, 1.0]), (106, [1.0, None]),
       (107, []), (None, [1.0, 2.5]), (108, [3.0]), (200, [1.5, 2.0]), (200, [1.5, 2.0]), (300, [4.0, 4.0, 4.0]), (110, [1.0, 2.1])]


def exact(ids, x, query, k):
    d = np.sqrt(((x - x[ids == query][0]) ** 2).sum(axis=1))
    d[ids == query] = np.inf
    order = np.lexsort((ids, d))[:k]
    return list(ids[order])


def table(spark, rows, seed, copies=0):
    x = np.random.default_rng(seed).normal(size=(rows, 24)).astype(np.float32)
    x[:copies] = x[0]
    return np.arange(rows), x


def test_graph_search_recall_over_several_shards(prepared, vectors):
    ids, x = table(prepared, 1500, 1)
    df = vectors(list(zip(ids.tolist(), x.tolist(), strict=True))).repartition(4)
    rows = hnsw.search(df, F.col("vec_id") % 50 == 0, k=10, shard_rows=500, ef_search=64).collect()
    hits = 0
    for query in range(0, 1500, 50):
        found = sorted((r.rank, r.vec_id, r.score) for r in rows if r.query_id == query)
        assert [f[0] for f in found] == list(range(1, 11))
        hits += len({f[1] for f in found} & set(exact(ids, x.astype(float), query, 10)))
        for _, other, score in found:
            assert math.isclose(score, math.dist(x[query].astype(float), x[other].astype(float)), rel_tol=1e-12)
    assert hits >= 0.95 * 300


@pytest.mark.parametrize("kind", ["centred", "shifted", "clustered", "clustered and shifted"])
def test_graph_recall_with_registered_parameters(kind):
    """One whole shard, built and searched as ``op1`` does."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(hnsw.SHARD_ROWS // 2, 32))
    if "clustered" in kind:
        x = rng.normal(size=(20, 32))[rng.integers(0, 20, len(x))] * 5 + 0.05 * x
    x = (x + (3_000 if "shifted" in kind else 0)).astype(np.float32).astype(np.float64)
    graph, hits = hnsw.Graph(x).build(hnsw.EF_BUILD), 0
    for q in x[::40]:
        hits += len(set(graph.nearest(q, hnsw.EF_SEARCH)[:10].tolist()) & set(np.argsort(((x - q) ** 2).sum(axis=1), kind="stable")[:10].tolist()))
    assert hits >= 0.95 * 10 * len(x[::40])


def test_graph_search_with_a_third_of_copies(prepared, vectors):
    ids, x = table(prepared, 900, 2, copies=300)
    df = vectors(list(zip(ids.tolist(), x.tolist(), strict=True)))
    rows = hnsw.search(df, F.col("vec_id") == 50, k=10).collect()
    assert [(r.vec_id, r.score) for r in sorted(rows, key=lambda r: r.rank)] == [(i, 0.0) for i in range(10)]


def test_graph_is_flat_and_comes_back(prepared):
    x = np.random.default_rng(3).normal(size=(400, 8))
    graph = hnsw.Graph(x).build()
    flat = graph.flat()
    assert all(len(f) == hnsw.M * (2 + graph.level[n]) for n, f in enumerate(flat))
    again = hnsw.Graph.of(x, flat, hnsw.M)
    assert (again.level == graph.level).all() and all((a == b).all() for a, b in zip(again.links, graph.links, strict=True))


def test_graph_search_edge_cases(vectors):
    rows = hnsw.search(vectors(ODD), F.col("vec_id") % 100 == 0, k=10).collect()
    found = {q: [(r.vec_id, r.score) for r in sorted(rows, key=lambda r: r.rank) if r.query_id == q] for q in {r.query_id for r in rows}}
    assert set(found) == {100, 200}  # 300 has no candidate of its length
    assert [i for i, _ in found[100]] == [101, 101, 110, 200, 200]
    assert [i for i, _ in found[200]] == [100, 101, 101, 110]
    assert hnsw.search(vectors([]), F.col("vec_id") % 100 == 0).count() == 0


def scores(rows, query, k):
    ints = [(i, [math.floor(256 * v) for v in x]) for i, x in rows]
    q = next(v for i, v in ints if i == query)
    every = [(-sum(a * b for a, b in zip(q, v, strict=True)), i) for i, v in ints if i != query and len(v) == len(q)]
    return [(i, -s) for s, i in sorted(every)[:k]]


def test_topk_equals_brute_force(prepared, vectors):
    for seed, copies in ((5, 0), (6, 250)):
        ids, x = table(prepared, 700, seed, copies)
        rows = list(zip(ids.tolist(), x.tolist(), strict=True))
        for lists in (1, 2, 4):
            found = topk.search(vectors(rows), F.col("vec_id") % 50 == 0, k=5, lists=lists, block_rows=200, query_rows=5).collect()
            for query in range(0, 700, 50):
                assert [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r.rank) if r.query_id == query] == scores(rows, query, 5)


def test_topk_edge_cases(vectors):
    found = topk.search(vectors(ODD), F.col("vec_id") % 50 == 0, k=5).collect()
    valid = [(i, v) for i, v in ODD if i is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    for query in (100, 200):
        assert [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r.rank) if r.query_id == query] == scores(valid, query, 5)
    assert {r.query_id for r in found} == {100, 200}
    assert topk.search(vectors([]), F.col("vec_id") % 50 == 0).count() == 0


def test_topk_scores_are_whole_numbers_of_any_size(vectors):
    big = float(1 << 22)  # 2**30 as a whole component
    rows = [(50, [big, -3.0]), (51, [big / 64 + 0.5, 2.0]), (52, [-big, 1.0]), (53, [8.0, big / 2])]
    found = {r.vec_id: r.score for r in topk.search(vectors(rows[:2] + rows[3:]), F.col("vec_id") == 50, k=3).collect()}
    whole = lambda v: [math.floor(256 * x) for x in np.array(v, dtype=np.float32).astype(float).tolist()]
    assert found == {i: sum(a * b for a, b in zip(whole(rows[0][1]), whole(v))) for i, v in (rows[1], rows[3])}
    for bad in ([1e30, 1.0], [big, big]):  # a component, or a score, that is no long
        with pytest.raises(Exception, match="too large|overflow|OVERFLOW"):
            topk.search(vectors([(50, [4e9, -4e9]), (51, [4e9, 4e9]), (53, bad), (54, [4e9, -4e9])]), F.col("vec_id") == 50, k=2).collect()
