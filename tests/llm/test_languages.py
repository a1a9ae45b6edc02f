from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from sluicemark.llm import languages
from tests.llm.conftest import EDGE


def reference(text, dimensions=languages.DIMENSIONS):
    """The bundle by the definition, one n-gram after the other."""
    letters = [c.lower() if c.isalpha() and len(c.lower()) == 1 else (c if c.isalpha() else " ") for c in text]
    framed = [0]
    for c in [*letters, " "]:
        code = 0 if c == " " else ord(c)
        if code or framed[-1]:
            framed.append(code)
    total = np.zeros(dimensions)
    if len(framed) > 2 - (framed[-1] != 0):
        for i in range(len(framed) - 2):
            vector = np.ones(dimensions)
            for place in range(3):
                vector = vector * np.roll(languages._letter_vector(int(framed[i + place]), dimensions), place)
            total += vector
    return total


def test_bundles_equal_the_definition():
    texts = ["The cat sat.", "ÄÖ über straße", "a", "x1y2z", "日本語 テスト", "many words " * 50]
    found = languages.bundles([*texts, None, "", "12 !"])
    for text, row in zip(texts, found, strict=False):
        assert np.allclose(row, reference(text)), text
    assert not found[len(texts) :].any()


def test_parts_of_long_texts_add_up(monkeypatch):
    text = "abc def ghij klmno " * 300
    whole = languages.bundles([text, "short one", text])
    monkeypatch.setattr(languages, "_PART", 100)
    monkeypatch.setattr(languages, "_PAIRS", 64)
    assert np.allclose(languages.bundles([text, "short one", text]), whole)


def test_held_out_accuracy(prepared):
    docs = prepared.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = languages.fold(F.col("doc_id")) == 1
    model = languages.learn(docs.filter(~held_out))
    rows = languages.predict(docs.filter(held_out), model).collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_edge_cases(edge, nothing):
    rows = languages.predict(edge, languages.learn(edge)).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == len(EDGE) and by[2].row == "row"
    assert {by[i].lang_pred for i in (3, 4, 5, 6)} == {"und"} and {by[i].score for i in (3, 4, 5, 6)} == {0.0}
    assert by[2].lang_pred == "de" and by[1].lang_pred == "en"
    assert languages.predict(nothing, languages.learn(nothing)).count() == 0
    assert {r.lang_pred for r in languages.predict(edge, languages.learn(nothing)).collect()} == {"und"}
