from __future__ import annotations

import math
import random
import re
from collections import defaultdict

import pytest

from sluicemark.llm import mixing
from tests.llm.conftest import EDGE, documents


def wanted(sizes, most=3, weights=(1, 2, 3)):
    """Targets by resharing the excess until no source is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free} if free else {}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return {**capped, **share}
        capped |= {s: most * sizes[s] for s in over}


def check(rows, tolerance):
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.size * r.copies
        target[r.source] = r.target
        assert 0 <= r.copies <= 3
    for s, t in wanted(sizes).items():
        assert target[s] == pytest.approx(t, rel=1e-9, abs=1e-6)
        assert abs(taken[s] - t) <= tolerance(s, t)


def test_targets_are_met_on_a_whole_table(prepared):
    docs = prepared.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    assert all(r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows)
    check(rows, lambda s, t: 0.02 * t)
    again = {r.doc_id: r.copies for r in mixing.mix(docs.repartition(3)).collect()}
    assert again == {r.doc_id: r.copies for r in rows}


def test_capped_sources(prepared):
    random.seed(2)
    rows = [(i, "w " * random.randrange(1, 40), "en", s) for i, s in enumerate(["a"] * 400 + ["b"] * 3 + ["c"] * 5 + [None] * 60)]
    check(mixing.mix(documents(prepared, rows)).collect(), lambda s, t: 40)


def test_rates_are_tilted_by_one_multiplier_per_source(prepared):
    rows = [(i, "w " * (1 + i % 30), "en", "ab"[i % 2]) for i in range(600)]
    for source in "ab":
        found = [r for r in mixing.mix(documents(prepared, rows)).collect() if r.source == source]
        assert sum(r.size * r.rate for r in found) == pytest.approx(found[0].target, rel=1e-5)
        slopes = {round(math.log(r.rate) / r.size, 9) for r in found if r.rate < 3}
        assert len(slopes) == 1


def test_edge_cases(edge, nothing):
    rows = mixing.mix(edge).collect()
    assert len(rows) == len(EDGE) and {"row", "key", "rank"} <= set(rows[0].asDict()) and rows[0].row == "row"
    assert {r.size for r in rows if r.doc_id in (3, 4, 5)} == {0}
    assert len({r.copies for r in rows if r.doc_id == 1}) == 1
    assert mixing.mix(nothing).count() == 0
    assert mixing.mix(edge.filter("doc_id in (3, 4)")).count() == 2
