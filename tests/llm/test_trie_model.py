"""Elias-Fano sequences against sorted arrays; model scores against a plain n-gram model."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sluicemark.llm import trie_model
from sluicemark.llm.elias_fano import EliasFano, TrieShard, probability, quantise
from tests.llm.conftest import EDGE, documents

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


@pytest.mark.parametrize("n, universe", [(0, 1), (1, 1), (1, 100), (1000, 50), (1000, 10**6), (5000, 2**60), (300_000, 2**22)])
def test_sequences(tmp_path, n, universe):
    rng = np.random.default_rng(1)
    values = np.sort(rng.integers(0, universe, n))
    sequence = EliasFano.write(values, tmp_path, "x")
    assert (sequence.access(np.arange(n)) == values).all()
    asked = np.concatenate([rng.integers(0, universe + 5, 2000), values[:500], values[:500] + 1])
    place, equal = sequence.successor(asked)
    assert (place == np.searchsorted(values, asked)).all() and (equal == np.isin(asked, values)).all()


def test_shard_finds_its_entries_and_no_others(tmp_path):
    rng = np.random.default_rng(2)
    pairs = np.unique(np.stack([rng.integers(0, 300, 20_000) * 977, rng.integers(0, 5_000, 20_000)], axis=1), axis=0)
    shard = TrieShard(pairs[:, 0], pairs[:, 1], np.full(len(pairs), 0.25), np.arange(len(pairs)), tmp_path)
    contexts, sizes = np.unique(pairs[:, 0], return_counts=True)
    assert (shard.find(contexts, sizes, pairs[:, 1]) == np.arange(len(pairs))).all()
    assert (shard.find(contexts + 1, sizes, pairs[:, 1]) == -1).all()
    held = {tuple(p) for p in pairs.tolist()}
    there = [(c, w + 1) in held for c, w in pairs.tolist()]
    assert ((shard.find(contexts, sizes, pairs[:, 1] + 1) >= 0) == there).all()
    assert sum(f.stat().st_size for f in tmp_path.iterdir()) < 8 * len(pairs)  # two 64-bit numbers would take 16


def test_quantised_probabilities():
    p = np.array([1.0, 0.3, 1e-7])
    assert np.abs(np.log10(probability(quantise(p))) - np.log10(p)).max() <= 0.5 / 4096 + 1e-12 and probability(np.zeros(1, dtype=np.int16))[0] == 0


def plain(rows, order, priors):
    texts = [(i, i is not None and zlib.crc32(str(i).encode()) % 7 == 2, [None, *re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)), ""]) for i, t in rows]
    grams, contexts = Counter(), Counter()
    for _, out, t in texts:
        for j in range(1, 0 if out else len(t)):
            grams[t[j],] += 1
            for k in range(2, min(order, j + 1) + 1):
                grams[tuple(t[j - k + 1 : j + 1])] += 1
                contexts[tuple(t[j - k + 1 : j])] += 1
    words = [g for g in grams if len(g) == 1]
    total = sum(grams[g] for g in words)
    found = []
    for i, out, t in texts:
        base = score = 0.0
        for j in range(1, len(t)):
            p = (grams[t[j],] + 1) / (total + len(words) + 1)
            base += math.log10(p)
            for k in range(2, min(order, j + 1) + 1):
                gram, prior = tuple(t[j - k + 1 : j + 1]), priors[k]
                seen = contexts[gram[:-1]]
                own = probability(quantise(np.array([grams[gram] / (seen + prior)])))[0] if grams[gram] else 0
                p = own + prior / (seen + prior) * p
            score += math.log10(p)
        found.append((i, out, len(t) - 1, sum(grams[w,] > 0 for w in t[1:]), total, base, score))
    return found


def same(found, expected):
    order = lambda rows: sorted(rows, key=lambda r: (r[0] is None, r[0], r[2], round(r[5], 6)))
    found, expected = order([tuple(r[c] for c in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")) for r in found]), order(expected)
    assert [r[:5] for r in found] == [r[:5] for r in expected]
    for a, b in zip(found, expected, strict=True):
        assert math.isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-9, abs_tol=1e-9)


@pytest.mark.parametrize("options", [{}, {"order": 2}, {"block_bytes": 20_000, "shard_tokens": 3_000}, {"order": 4, "block_bytes": 50_000, "shard_tokens": 800}])
def test_whole_table(prepared, options):
    docs = prepared.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = trie_model.score(docs, **options).collect()
    priors = [*trie_model.PRIORS, trie_model.PRIORS[-1]]
    same(found, plain([(r.doc_id, r.text) for r in docs.collect()], options.get("order", trie_model.ORDER), priors))
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_edge_rows(prepared, edge, nothing):
    for options in ({}, {"block_bytes": 1, "shard_tokens": 5}):
        same(trie_model.score(edge, **options).collect(), plain([(i, t) for i, t, _, _ in EDGE], trie_model.ORDER, trie_model.PRIORS))
    assert trie_model.score(nothing).count() == 0
    unseen = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = trie_model.score(documents(prepared, [(unseen, "nothing to learn from", "en", "a")])).collect()[0]
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.score) == (True, 5, 0, 0, 0.0)


def test_contexts_of_one_block_are_not_sent():
    grams = trie_model._Grams(np.array([3, 0, 1, 3]), np.array([0, 1, 2, 1]), 4)
    grams.deal(np.arange(4), np.array([1, 1, 1, 2]), np.array([True, False, True, False]), np.arange(4), np.ones(4, dtype=bool), 1, 100)
    pairs = lambda at: list(zip(grams.context[at].tolist(), grams.word[at].tolist()))
    assert pairs(grams.asked) == [(1, 2), (3, 0), (3, 1)] and pairs(grams.alone) == [(0, 1)]


def test_a_held_out_copy_in_another_block(prepared):
    """A block that has a context in training alone still sends it, if another block has it in a held-out document."""
    out = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    taught = [i for i in range(99) if zlib.crc32(str(i).encode()) % 7 != 2]
    rows = [(taught[0], "a b c d the shared phrase"), (taught[1], "e f g h the shared phrase"), (taught[2], "i j k l"), (out, "i j k l m")]
    docs = prepared.createDataFrame(rows, "doc_id long, text string")
    same(trie_model.score(docs, block_bytes=1).collect(), plain(rows, trie_model.ORDER, trie_model.PRIORS))


def test_shuffle_files_go_with_their_query(prepared, monkeypatch):
    """While the orders run, that is; the caller's setting is put back, after a failure too."""
    seen, plainly, before = [], trie_model.staged, prepared.conf.get(trie_model._CLEANUP)
    monkeypatch.setattr(trie_model, "staged", lambda df: seen.append(prepared.conf.get(trie_model._CLEANUP)) or plainly(df))
    docs = documents(prepared, [(i, f"a b c {i}", "en", "a") for i in range(9)])
    assert trie_model.score(docs, block_bytes=1).count() == 9
    assert seen == ["true"] and prepared.conf.get(trie_model._CLEANUP) == before
    with pytest.raises(ZeroDivisionError), trie_model._shuffles_removed(prepared):
        _ = 1 / 0
    assert prepared.conf.get(trie_model._CLEANUP) == before


def test_whole_numbers_come_back():
    for ends in ([0], [0, 255], [-1, 0], [-128, 127], [-129, 70_000], [0, 2**32], [-(2**40), 2**40], [0, 2**62]):
        values = np.array(ends, dtype=np.int64)
        assert trie_model.unpacked(trie_model.packed(values)).tolist() == ends and trie_model.unpacked(trie_model.packed(values, steps=True)).tolist() == ends


@pytest.mark.parametrize("most", [1, 50, 2**40, 2**61])
def test_ranks(most):
    keys = np.random.default_rng(3).integers(0, most, 5_000)
    for some in (keys, keys[:1], keys[:0]):
        distinct, rank = trie_model._ranked(some)
        expected = np.unique(some, return_inverse=True)
        assert (distinct == expected[0]).all() and (rank == expected[1]).all()


def test_a_shard_looks_an_ngram_up_once(monkeypatch):
    """However many blocks ask for it; a block that alone asked for one gets no count."""
    looked_up, plainly = [], trie_model._looked_up
    monkeypatch.setattr(trie_model, "_looked_up", lambda entries, contexts, sizes, words: looked_up.append(len(words)) or plainly(entries, contexts, sizes, words))
    # Contexts 7 and 9 with counts 6 and 2; 9 4 is held out in both blocks, 7 5 is asked by the first alone.
    asked = [([7, 9], [6, 2], [3, 1], [1, 2, 5, 4], [2, 0, 1, 0]), ([7, 9], [6, 2], [2, 2], [1, 2, 3, 4], [1, 2, 2, 0])]
    columns = [pa.array([trie_model.packed(np.array(row[c])) for row in asked], pa.binary()) for c in range(5)]
    rows = pa.Table.from_batches([trie_model._batch(trie_model.ASKED, pa.array([3, 3], pa.int64()), pa.array([0, 1], pa.int64()), *columns)])
    answer = trie_model._answer_shard(2, 200.0, last=False)(rows)
    assert looked_up == [5]
    codes, nodes, counts = ([trie_model.unpacked(blob).tolist() for blob in answer[c].to_pylist()] for c in ("codes", "nodes", "counts"))
    chance = lambda n, total: int(quantise(np.array([n / (total + 200.0)]))[0])
    assert codes == [[chance(3, 6), chance(2, 6), chance(1, 6), 0], [chance(3, 6), chance(2, 6), chance(2, 2), 0]]
    assert [n - (3 << 36) if n else None for n in nodes[0]] == [0, 1, 2, None] and [n - (3 << 36) if n else None for n in nodes[1]] == [0, 1, 3, None]
    assert counts == [[3, 2, 0, 0], [3, 2, 0, 0]]
