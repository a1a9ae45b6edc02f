"""The filter audit against a plain walk over all orders, on edge rows."""

from __future__ import annotations

import re
from collections import Counter
from itertools import permutations

from sluicemark.llm import filter_audit
from tests.llm.conftest import EDGE, documents

LABELS = "doc_id long, quality int, toxic int, part string, mask int"


def plain(rows, labels):
    least = {}
    for i, text, _, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    docs = []
    for i, text, _, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search("[#$%&*|]", text)), "E": i is not None and least[text] < i,
        }
        docs.append((source or "", {f for f, bad in fails.items() if bad}, i in good, i in toxic))
    found, shapley = {}, Counter()
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                earlier = [d for d in own if f in d[1] and d[1] & set(order[: step - 1])]
                unique = sum(d[1] == {f} for d in own)
                found[part, "".join(order), step] = (len(left), len(gone), len(earlier), unique, sum(d[2] for d in gone), sum(d[3] for d in gone))
                shapley[part, f] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in found.items()}


def test_equals_a_plain_walk(prepared, nothing):
    rows = [*EDGE, (14, "AAAA $ " * 60, "en", ""), (13, "AAAA $ " * 60, "en", None), (13, "AAAA $ " * 60, "en", "b"), (None, "no id here at all", "en", "a")]
    rows += [(100 + i, "a copy that is everywhere", "en", "abc"[i % 3]) for i in range(50)]
    labels = [(1, 1, 0), (1, 0, None), (3, None, 1), (8, 1, 1), (11, 1, 0), (None, 1, 1), (120, 1, 0), (999, 1, 1)]
    known = prepared.createDataFrame([(*r, "p", 3) for r in labels], LABELS)
    found = filter_audit.audit(documents(prepared, rows), known)
    assert found.columns[:3] == ["part", "filter_order", "step"]
    assert {tuple(r)[:3]: tuple(r)[3:] for r in found.collect()} == plain(rows, labels)
    assert filter_audit.audit(nothing, known).count() == 0
    unlabelled = filter_audit.audit(documents(prepared, rows), known.limit(0))
    assert {tuple(r)[:3]: tuple(r)[3:] for r in unlabelled.collect()} == plain(rows, [])


def test_more_parts_than_the_recursion_guard_allows_rows(prepared):
    """325 rows a part pass a guard of a million rows from 3,077 parts on; the guard is lifted and put back."""
    before = prepared.conf.get("spark.sql.cteRecursionRowLimit")
    cells = prepared.range(3_200).selectExpr("cast(id AS string) AS part", "cast(id % 32 AS int) AS mask", "1L AS n", "0L AS good", "0L AS toxic")
    assert filter_audit.enumerate_orders(cells).count() == 3_200 * 325
    assert prepared.conf.get("spark.sql.cteRecursionRowLimit") == before
