"""The conversation trie against its SQL at small sizes, its edge rows and its spilling queue."""

from __future__ import annotations

import random

import duckdb
import pytest

from sluicemark.llm import prefix_trie
from tests.oracle import compare

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth int, hi long, family string, conv string"


def made(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2, "f", "c") for r in rows], SCHEMA)


def against_sql(df, rows, **options):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    return compare(prefix_trie.trie(df, **options), con, prefix_trie.ORACLE)


def many(seed):
    rng = random.Random(seed)
    rows = [(c, t, rng.choice(["user", "assistant"]), rng.choice("abc")) for c in range(300) for t in range(rng.randint(0, 12))]
    return rows + [(c, t, "user", "same") for c in range(300, 600) for t in range(3)]  # one conversation that is everywhere


@pytest.mark.parametrize("options", [{}, {"top": 3, "queue_rows": 4}, {"top": 10**6, "queue_rows": 7}])
def test_equals_sql(prepared, options):
    rows = many(len(options))
    assert against_sql(made(prepared, rows), rows, **options) > 300


def test_edge_rows(prepared):
    rows = [
        (0, 1, "user", "hello"), (0, 0, "user", "first"), (0, None, "system", "before all"), (0, 1, "user", "hello"),  # a null and a repeated turn
        (1, 0, None, None), (2, 0, "", ""), (None, 0, "user", "no id"), (7, 3, "user", "no base"), (12, 0, "user", "x" * 300_000), (-3, 0, "user", "negative"),
        (20, 0, "user", "é" * 10), (21, 0, "user", "é" * 10), *[(30, t, "user", f"turn {t}") for t in range(500)], *[(31, t, "user", f"turn {t}") for t in range(500)],
    ]
    assert against_sql(made(prepared, rows), rows) > 500
    assert against_sql(made(prepared, rows), rows, top=1, queue_rows=1) > 500
    assert prefix_trie.trie(made(prepared, [])).count() == 0


def test_queue_spills_in_order():
    rng = random.Random(3)
    queue, kept, out = prefix_trie.SpillingQueue(2, most=10), [], []
    for _ in range(20_000):
        if kept and rng.random() < 0.4:
            assert queue.first() == min(kept)
            out.append(queue.pop())
            kept.remove(out[-1])
        elif len(kept) < 3_000:
            item = (rng.randint(-50, 50), rng.randint(-(2**62), 2**62))
            queue.push(item)
            kept.append(item)
    assert [queue.pop() for _ in kept] == sorted(kept) and queue.first() is None
    queue.close()
