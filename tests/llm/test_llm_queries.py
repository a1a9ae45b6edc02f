"""The registered queries: those with SQL equal it, and the pipeline keeps its stages' promises."""

from __future__ import annotations

import random
import re

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from sluicemark.llm import packing, simhash
from sluicemark.session import staged
from tests.llm.conftest import documents
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.01"
NAMES = sorted(n for n in queries() if re.match(r"op\d+_", n))


def test_every_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in NAMES) == list(range(1, 14)) and "pipeline" in queries()


@pytest.mark.parametrize("name", [n for n in NAMES if n in oracle_sql()])
def test_query_matches_sql(prepared, name):
    assert compare(queries()[name](prepared, SF_DIR), connect(SF_DIR), oracle_sql()[name]) > 0


def test_native_queries_use_no_python(prepared):
    for name in NAMES:
        if re.match(r"op(4|6|10)_", name):
            plan = queries()[name](prepared, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
            assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


def test_pipeline_stages(prepared):
    docs = prepared.read.parquet("/root/testdata/sf0.001/documents.parquet")
    seen = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(prepared, docs, "/root/testdata/sf0.001"))
        seen[name] = docs
    for name in ("language", "lines", "near_duplicates", "mixing"):
        assert tuple(seen[name].columns) == corpus_pipeline.COLUMNS
    ids = {k: [r[0] for r in v.select("doc_id").collect()] for k, v in seen.items()}
    letters = {r.doc_id for r in seen["documents"].collect() if any(c.isalpha() for c in r.text)}
    assert set(ids["language"]) == letters
    groups = {r.doc: r.component for r in simhash.components_within(seen["lines"]).collect()}
    assert sorted(ids["near_duplicates"]) == sorted({groups[i] for i in ids["lines"]})
    copies = {i: ids["mixing"].count(i) for i in set(ids["mixing"])}
    assert set(copies) <= set(ids["near_duplicates"]) and max(copies.values()) <= 3
    tokens = sum(len(packing.encoder_at(packing.TOKENIZER).encode(r.text)) + 1 for r in seen["mixing"].collect())
    assert sum(r.length for r in seen["packing"].collect()) == tokens
    whole = corpus_pipeline.run(prepared, "/root/testdata/sf0.001")
    assert whole.count() == seen["packing"].count()


def test_pipeline_on_edge_rows(prepared, edge, nothing):
    plain = edge.select(*corpus_pipeline.COLUMNS)
    for docs in (plain, plain.limit(0), nothing):
        for name, stage in corpus_pipeline.STAGES:
            docs = staged(stage(prepared, docs, "unused"))
        assert docs.columns[0] == "doc_id"


def test_near_duplicate_stage_keeps_one_of_each_group(prepared):
    text = " ".join(f"word{i}" for i in range(200))
    rows = [(3, text, "en", "a"), (2, text, "en", "b"), (2, text, "en", "b"), (5, text.upper(), "en", "a"), (7, "something else entirely", "en", "a"), (None, text, "en", "a"),
            (None, "without id", "en", "a")]
    found = corpus_pipeline.dedup_near(prepared, documents(prepared, rows), "")
    assert sorted(str(r.doc_id) for r in found.collect()) == ["2", "7", "None"]


def test_line_stage_keeps_what_is_left_of_a_document(prepared):
    licence = " ".join(f"licence{i}" for i in range(60))
    rows = [(s, f"{licence}\n" + " ".join(f"own{s}x{i}" for i in range(55)), "en", f"site{s}") for s in range(12)]
    rows += [(20, licence, "en", "site1")]
    found = {r.doc_id: r.text for r in corpus_pipeline.dedup_lines(prepared, documents(prepared, rows), "").collect()}
    assert found == {i: text if i == 0 else text.split("\n")[1] for i, text, _, _ in rows if i != 20}


FOREIGN = [
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
    "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
]


def test_language_stage_rejects_what_is_like_no_language(prepared):
    clean = prepared.read.parquet(f"{SF_DIR}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    rng = random.Random(6)
    salad = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(150))
    greek, han = "αβγδεζηθικλμνξοπρστυφχψω", "".join(map(chr, range(0x4E00, 0x5100)))
    junk = [*FOREIGN, *[salad(a) for a in ("abcdefghijklmnopqrstuvwxyz", greek, han) for _ in range(40)]]
    planted = documents(prepared, [(10**9 + i, t, None, "a") for i, t in enumerate(junk)]).select(*corpus_pipeline.COLUMNS)
    kept = {r.doc_id for r in corpus_pipeline.identify_language(prepared, clean.union(planted), "").select("doc_id").collect()}
    assert {r.doc_id for r in clean.collect()} <= kept
    assert sum(i >= 10**9 for i in kept) <= len(junk) * 0.05 and not kept & {10**9, 10**9 + 1}
