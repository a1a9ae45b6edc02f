from __future__ import annotations

from collections import defaultdict

from sluicemark.llm import hosts

SCHEMA = "page_id long, url string, html string, host string, weight int, kind string, rank int, a string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "host", 1, "kind", 2, "a") for r in rows], SCHEMA)


def test_hosts_paths_and_rules(prepared):
    rows = [
        (1, "HTTP://WWW.Example.COM/en/1?x=/y", None), (2, "https://example.com/en/2#a", None), (3, "http://a.b.net/fr/?q", ""), (4, "http://notexample.com/en/", None),
        (5, "no scheme/at all", "<a href='//x.org/'>"), (6, None, None), (7, "http://example.com?en/", None), (8, "http://com/", None), (9, "x://telecom/", None),
        (10, "http://net/es/", None), (1, "HTTP://WWW.Example.COM/en/1?x=/y", None),
    ]
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in hosts.judge(table(prepared, rows)).collect()}
    assert found[1] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert found[2] == ("example.com", "/en/2", "example.com/en/", "block")
    assert found[3] == ("a.b.net", "/fr/", "net/fr/", "block")
    assert found[4] == ("notexample.com", "/en/", "com/", "allow")
    assert found[5] == found[6] == ("", "", None, "allow")
    assert found[7][:3] == ("example.com", "", None)
    assert found[8][2] == "com/" and found[9][2] is None and found[10][2] == "net/es/"
    assert hosts.judge(table(prepared, rows)).count() == len(rows)
    assert hosts.judge(table(prepared, [])).count() == 0


def test_ranks_equal_power_iteration(prepared):
    edges = [("g", "a", 1.0), ("a", "b", 2.0), ("b", "a", 1.0), ("b", "s", 1.0), ("s", "t", 3.0), ("t", "s", 1.0), ("a", "s", 1.0)]
    seeds = [("g", 0.7, 0.0), ("b", 0.3, 0.0), ("t", 0.0, 1.0)]
    frame = prepared.createDataFrame(edges, "a string, b string, weight double")
    found = {r.host: (r.trust, r.distrust) for r in hosts.host_ranks(frame, prepared.createDataFrame(seeds, "host string, trust double, distrust double")).collect()}

    def walk(links, start):
        out = defaultdict(float)
        for a, _, w in links:
            out[a] += w
        rank = dict(start)
        for _ in range(hosts.STEPS):
            new = defaultdict(float, {k: v * (1 - hosts.DAMPING) for k, v in start.items()})
            for a, b, w in links:
                new[b] += hosts.DAMPING * rank.get(a, 0.0) * w / out[a]
            rank = new
        total = sum(rank.values())
        return {k: v / total for k, v in rank.items()}

    trust = walk(edges, {h: t for h, t, _ in seeds if t})
    distrust = walk([(b, a, w) for a, b, w in edges], {h: d for h, _, d in seeds if d})
    for host in set(trust) | set(distrust):
        assert abs(found[host][0] - trust.get(host, 0)) < 1e-9 and abs(found[host][1] - distrust.get(host, 0)) < 1e-9


def test_links_carry_trust_and_distrust(prepared):
    link = lambda *to: "".join(f'<a href="https://{t}/x">t</a>' for t in to)
    rows = [
        (1, "http://good.com/", link("friend.org")), (2, "http://friend.org/", link("friends.friend.org")), (3, "http://bad.net/es/", link("farm.info")),
        (4, "http://farm.info/", link("bad.net")), (5, "http://lonely.info/", ""),
    ]
    found = {r.page_id: r.verdict for r in hosts.judge(table(prepared, rows)).collect()}
    assert found == {1: "allow", 2: "allow", 3: "block", 4: "block", 5: "allow"}
