from __future__ import annotations

import random
from itertools import combinations

import xxhash

from sluicemark.llm import simhash
from sluicemark.llm.graphs import components


def reference(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if sum(h >> i & 1 for h in hashes) * 2 > len(hashes))


def grouped(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_masks_cover_every_small_difference():
    for bits, radius in ((64, 2), (20, 3), (12, 4)):
        masks = simhash.masks(bits, radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for n in range(1, radius + 1):
            for places in combinations(range(bits if n < 3 else 12), n):
                assert any(not any(m >> p & 1 for p in places) for m in masks)


def test_components_equal_brute_force(prepared):
    docs = prepared.read.parquet("/root/testdata/sf0.001/documents.parquet")
    prints = {r.doc_id: reference(r.text) for r in docs.collect()}
    near = [(a, b) for a, b in combinations(sorted(prints), 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    groups = grouped(sorted(prints), near)
    found = {r.doc: (r.fingerprint, r.component) for r in simhash.components_within(docs).collect()}
    assert found == {k: (f"{v:016x}", groups[k]) for k, v in prints.items()}


def test_links_of_fingerprints_a_few_bits_apart(prepared):
    random.seed(4)
    prints = set()
    for _ in range(30):
        at = random.getrandbits(64)
        for _ in range(12):
            for _ in range(random.choice([0, 1, 2, 2, 3])):
                at ^= 1 << random.randrange(64)
            prints.add(at)
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    near = [(a, b) for a, b in combinations(signed, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2]
    links = simhash.links_within_two(prepared.createDataFrame([(s,) for s in signed], "f long"))
    assert all(((r.f ^ r.to) & (1 << 64) - 1).bit_count() <= 2 for r in links.collect())
    joined = grouped(signed, near)
    assert {r.node: r.component for r in components(links, "f", "to").collect()} == {k: v for k, v in joined.items() if list(joined.values()).count(v) > 1}


def test_components_of_random_graphs(prepared):
    random.seed(1)
    for links in ([(random.randrange(300), random.randrange(300)) for _ in range(200)], [(i, i + 1) for i in range(120)], [(3, 3)], []):
        expected = grouped(sorted({n for e in links if e[0] != e[1] for n in e}), [e for e in links if e[0] != e[1]])
        frame = prepared.createDataFrame(links, "a long, b long")
        assert {r.node: r.component for r in components(frame).collect()} == expected


def test_edge_cases(edge, nothing):
    rows = simhash.components_within(edge).collect()
    by = {r.doc: r for r in rows}
    assert len(rows) == 13 and by[3].fingerprint == by[4].fingerprint == "0" * 16
    assert by[3].component == by[4].component == by[5].component == 3 and by[11].component == 1 and None in by
    assert simhash.components_within(nothing).count() == 0
