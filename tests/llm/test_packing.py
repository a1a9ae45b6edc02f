from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sluicemark.llm import packing
from tests.llm.conftest import EDGE, documents


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_words_encoded_apart_give_the_ids_of_the_whole(tokenizer):
    random.seed(5)
    alphabet = [" ", "  ", "\n", "\t", "a", "Be", "12", "'s", "'", ".", "é", "ß", " ", "\x1c", "<|endoftext|>", "日本", "don't", "!!", "word"]
    encoder = packing.Encoder(packing.TOKENIZER)
    for _ in range(3000):
        text = "".join(random.choice(alphabet) for _ in range(random.randrange(14)))
        assert encoder.encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_cuts_cover_a_document_and_fit_their_class():
    for length in [*range(1, 5000), 100_000]:
        pieces = packing.cuts(length)
        assert sum(n for _, n in pieces) == length
        for kind, n in pieces:
            assert n >= 1 and (kind == 0 and n <= 32 or kind * n <= 2048 and (kind * n >= 2048 * (1 - packing.SLACK)) or kind and n == 2048 // kind)


def check(rows, texts, tokenizer, capacity=2048):
    """Every id in one piece, gapless sequences; returns the share of padding."""
    tokens = {k: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for k, t in texts.items()}
    at, held = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.array(tokens[r.doc_id][r.start : r.start + r.length], dtype="<u4")
        assert len(ids) == r.length and r.doc_tokens == len(tokens[r.doc_id]) and zlib.crc32(ids.tobytes()) == r.ids_crc32
        at[r.doc_id] += range(r.start, r.start + r.length)
        held[r.sequence_id].append((r.offset, r.length))
    padding = total = 0
    for pieces in held.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
        total += end
        padding += 0 if end & (end - 1) == 0 else capacity - end
    return at, {k: len(v) for k, v in tokens.items()}, padding / max(total, 1)


def test_round_trip_on_a_whole_table(prepared, tokenizer):
    docs = prepared.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = packing.pack(docs).collect()
    at, sizes, padding = check(rows, {r.doc_id: r.text for r in docs.collect()}, tokenizer)
    assert {k: sorted(v) for k, v in at.items()} == {k: list(range(n)) for k, n in sizes.items()}
    assert padding < 0.03
    assert sorted(map(tuple, rows)) == sorted(map(tuple, packing.pack(docs).collect()))


def test_edge_cases(edge, tokenizer):
    rows = packing.pack(edge).collect()
    at, sizes, _ = check(rows, {i: t for i, t, _, _ in EDGE}, tokenizer)
    assert sorted(at[1]) == sorted([*range(sizes[1])] * 2)  # the repeated row is packed twice
    assert sizes[3] == sizes[4] == 1 and sorted(at[8]) == list(range(sizes[8])) and at[None]


def test_empty_table(nothing):
    assert packing.pack(nothing).count() == 0


def test_classes_hold_their_number_of_pieces(prepared):
    docs = documents(prepared, [(i, "a " * 1020, "en", "s") for i in range(40)]).coalesce(1)
    by = defaultdict(list)
    for r in packing.pack(docs).collect():
        by[r.sequence_id].append(r["class"])
    assert all(len(set(kinds)) == 1 for kinds in by.values())
    assert all(kinds[0] == 0 or len(kinds) == kinds[0] for kinds in by.values())
