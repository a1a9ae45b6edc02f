from __future__ import annotations

import time
from collections import defaultdict

from sluicemark.llm import lines
from tests.llm.conftest import EDGE, documents


def expected(rows, min_sites, min_words):
    sites, first = defaultdict(set), {}
    for i, text, _, source in rows:
        for pos, raw in enumerate((text or "").split("\n") if text is not None else []):
            line = raw.strip(" \t\n\x0b\f\r")
            if len(line.split()) >= min_words:
                sites[line].add(source)
                place = (i is not None, i or 0, pos)
                first[line] = min(first.get(line, place), place)
    spread = {k for k, v in sites.items() if len(v - {None}) >= min_sites}
    out = []
    for i, text, _, _ in rows:
        if text is None:
            out.append((i, None))
            continue
        kept = [raw for pos, raw in enumerate(text.split("\n"))
                if not ((line := raw.strip(" \t\n\x0b\f\r")) in spread and (i is not None, i or 0, pos) != first[line])]
        out.append((i, "\n".join(kept)))
    return sorted(out, key=str)


def test_threshold_is_exact_around_the_limit(prepared):
    rows = []
    for n in range(1, 40):  # line n is on n sites
        rows += [(1000 * n + s, f"own text {n} {s}\n  a line on {n} sites \nend of {n} {s}", "en", f"site{s}") for s in range(n)]
    found = lines.drop_spread_lines(documents(prepared, rows), min_sites=10)
    assert sorted(((r.doc_id, r.text) for r in found.collect()), key=str) == expected(rows, 10, 3)
    removed = {r.doc_id // 1000 for r in found.collect() if r.n_removed}
    assert removed == set(range(10, 40))


def test_edge_cases(prepared, edge, nothing):
    rows = [*EDGE, (12, "share this page now", None, None), (13, "share this page now", None, None),
            *[(20 + s, "\nshare this page now\n\n  \nx", None, f"s{s}") for s in range(12)], (None, "share this page now", None, "z")]
    found = lines.drop_spread_lines(documents(prepared, rows), min_sites=3).collect()
    assert sorted(((r.doc_id, r.text) for r in found), key=str) == expected(rows, 3, 3)
    assert found[0].row == "row" and found[0].line == "line"
    assert lines.drop_spread_lines(nothing).count() == 0
    assert lines.drop_spread_lines(edge).count() == len(EDGE)


def test_long_lines_need_fewer_sites_and_long_texts_are_rebuilt(prepared):
    long, middle, short = " ".join(f"w{i}" for i in range(60)), " ".join(f"m{i}" for i in range(25)), "a short line here"
    rows = [(s, f"own {s} text\n{long}\n{middle}\n{short}", "en", f"site{s}") for s in range(7)]
    found = {r.doc_id: r.text.split("\n") for r in lines.drop_spread_lines(documents(prepared, rows)).collect()}
    assert found[0] == rows[0][1].split("\n") and all(found[s] == [f"own {s} text", short] for s in range(1, 7))
    two = [(s, f"own {s} text\n{long}", "en", f"site{s}") for s in range(2)]
    assert sum(r.n_removed for r in lines.drop_spread_lines(documents(prepared, two)).collect()) == 0
    many = "\n".join(f"{'shared' if i % 2 else 'own'} line number {i}" for i in range(60_000))
    rows = [(s, many if s == 2 else "\n".join(f"shared line number {i}" for i in range(1, 60_000, 2)), "en", f"site{s}") for s in range(3)]
    started = time.perf_counter()
    found = {r.doc_id: r for r in lines.drop_spread_lines(documents(prepared, rows), min_sites=3).collect()}
    assert found[2].n_removed == 30_000 and found[2].text.count("\n") == 29_999 and found[1].text == "" and time.perf_counter() - started < 60
