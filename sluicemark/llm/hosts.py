"""Judge urls by rules and, where none fits, by the link graph of their hosts.

Hosts whose pages a rule allows are trusted seeds, hosts whose pages a rule blocks are blocked seeds, each
by its share of such pages.  Trust is a personalised page rank along host links, distrust one
against them; a host is blocked when its distrust is over ``ratio`` times its trust.  Edges are links
of the html to other hosts, weighed by the number of pages that hold them, and both ways between a
host and its parent domain, down to two labels.

Only DataFrame operations are used.  Both ranks move in one join and one sum per step, ranks are
written to the shared folder every few steps, and a host with many pages or links is summed before
the shuffle or split in the join.  Mass that reaches a host without links is lost; that scales all
ranks of a seed set alike, and they are compared after scaling each set to 1.

A null url, or one without ``://``, has an empty host and path, fits no rule and is allowed: nothing is
known of it.  Null html has no links; a very long one is searched in one task, in memory proportional to it.  Repeated rows are judged alike.  Of rules as
long the one with the longer host wins, and a host whose distrust equals ``ratio`` times its trust is allowed.  An empty table gives no
rows.  Other columns are kept; one with the name of an added column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicemark.session import staged

# (verdict, host and path); a rule fits its host and all subdomains where the path starts with its own.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
DAMPING = 0.85
STEPS = 20
STEPS_PER_WRITE = 5
RATIO = 1.0
ADDED = ("host", "path", "rule", "verdict", "trust", "distrust")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The host of a link, without user and port; tags may be spelled in any case.
LINK = r"""(?i:href)[\x20\x09-\x0D]*=[\x20\x09-\x0D]*["']?[\x20\x09-\x0D]*(?i:https?:)?//(?:[^/"'?#<>@\x20\x09-\x0D]*@)?([^/"'?#<>:@\x20\x09-\x0D]+)"""


def host_of(url: Column) -> Column:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3))
    return F.translate(F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _fitting(rules: tuple[tuple[str, str], ...], host: Column, path: Column, value: int) -> Column:
    """Field ``value`` of the longest fitting rule, or null.  Of rules as long, the one with the longer host."""
    found = None
    for rule in sorted(rules, key=lambda r: (-len(r[1]), r[1].find("/"))):
        domain, slash, rest = rule[1].partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        found = F.when(fits, rule[value]) if found is None else found.when(fits, rule[value])
    return F.lit(None).cast("string") if found is None else found


def host_edges(pages: DataFrame) -> DataFrame:
    """(a, b, weight): links between hosts of ``pages`` (host, links), and of hosts with their parents."""
    links = (
        pages.select("host", F.explode(F.array_distinct("links")).alias("b")).filter((F.col("host") != "") & (F.col("b") != F.col("host")))
        .groupBy(F.col("host").alias("a"), "b").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )
    names = pages.select("host").filter(F.col("host") != "").union(links.select("b")).distinct()
    labels = F.split("host", r"\.")
    depth = F.when(F.size(labels) > 2, F.sequence(F.lit(1), F.size(labels) - 2)).otherwise(F.array().cast("array<int>"))

    def name(labels: Column, first: Column) -> Column:
        return F.array_join(F.slice(labels, first, F.size(labels)), ".")

    chain = names.select(labels.alias("labels"), F.explode(depth).alias("i"))
    up = chain.select(name(F.col("labels"), F.col("i")).alias("a"), name(F.col("labels"), F.col("i") + 1).alias("b")).distinct()
    both = up.union(up.select("b", "a")).withColumn("weight", F.lit(1.0))
    return links.unionByName(both).groupBy("a", "b").agg(F.sum("weight").alias("weight"))


def host_ranks(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, steps: int = STEPS) -> DataFrame:
    """(host, trust, distrust) of every host reached from ``seeds`` (host, trust, distrust)."""
    out = edges.groupBy("a").agg(F.sum("weight").alias("total"))
    into = edges.groupBy("b").agg(F.sum("weight").alias("total"))
    share = F.col("weight") / F.col("total")
    along = edges.join(out, "a").select(F.lit("trust").alias("kind"), F.col("a").alias("host"), F.col("b").alias("to"), share.alias("share"))
    against = edges.join(into, "b").select(F.lit("distrust").alias("kind"), F.col("b").alias("host"), F.col("a").alias("to"), share.alias("share"))
    flows = staged(along.union(against))
    start = seeds.select("host", F.stack(F.lit(2), F.lit("trust"), "trust", F.lit("distrust"), "distrust").alias("kind", "rank"))
    start = staged(start.filter(F.col("rank") > 0).select("kind", "host", "rank"))
    ranks = start
    for step in range(1, steps + 1):
        moved = flows.join(ranks, ["kind", "host"]).select("kind", F.col("to").alias("host"), (F.col("rank") * F.col("share") * damping).alias("rank"))
        fresh = start.withColumn("rank", F.col("rank") * (1 - damping))
        ranks = moved.union(fresh).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if step % STEPS_PER_WRITE == 0 or step == steps:
            ranks = staged(ranks)
    mass = {r["kind"]: r["mass"] for r in ranks.groupBy("kind").agg(F.sum("rank").alias("mass")).collect()}
    return ranks.groupBy("host").agg(*[
        F.sum(F.when(F.col("kind") == k, F.col("rank") / (mass.get(k) or 1.0)).otherwise(0.0)).alias(k) for k in ("trust", "distrust")
    ])


def judge(
    pages: DataFrame,
    url: str = "url",
    html: str = "html",
    rules: tuple[tuple[str, str], ...] = RULES,
    damping: float = DAMPING,
    steps: int = STEPS,
    ratio: float = RATIO,
) -> DataFrame:
    """``pages`` with host, path, rule, verdict, trust and distrust; ``rules`` are few enough for one expression."""
    u = F.col(url)
    links = F.transform(F.regexp_extract_all(F.col(html), F.lit(LINK), 1), lambda x: F.translate(x, UPPER, LOWER))
    facts = staged(
        pages.select(host_of(u).alias("host"), path_of(u).alias("path"), F.coalesce(links, F.array().cast("array<string>")).alias("links"))
        .withColumn("said", _fitting(rules, F.col("host"), F.col("path"), 0))
    )
    edges = staged(host_edges(facts))
    by_host = facts.filter(F.col("host") != "").groupBy("host").agg(
        F.count(F.when(F.col("said") == "allow", 1)).alias("good"), F.count(F.when(F.col("said") == "block", 1)).alias("bad")
    )
    seeds = staged(by_host.filter((F.col("good") > 0) | (F.col("bad") > 0)))
    total = seeds.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    shares = [(F.col(c) / float(total[c] or 1)).alias(k) for c, k in (("good", "trust"), ("bad", "distrust"))]
    scored = staged(host_ranks(edges, seeds.select("host", *shares), damping, steps))

    own = F.struct(*[F.col(f"`{c}`") for c in pages.columns if c.lower() not in ADDED]).alias("row")
    named = pages.select(own, host_of(u).alias("host"), path_of(u).alias("path"))
    joined = named.join(scored, "host", "left")
    host, path = F.col("host"), F.col("path")
    guilty = F.coalesce(F.col("distrust") > F.col("trust") * ratio + 1e-12, F.lit(False))
    verdict = F.coalesce(_fitting(rules, host, path, 0), F.when(guilty, "block").otherwise("allow"))
    return joined.select("row.*", host, path, _fitting(rules, host, path, 1).alias("rule"), verdict.alias("verdict"), "trust", "distrust")


def _oracle() -> str:
    """The same for DuckDB, each step of the ranks a table of its own."""
    fits = []
    for verdict, rule in sorted(RULES, key=lambda r: (-len(r[1]), r[1].find("/"))):
        domain, slash, rest = rule.partition("/")
        fits.append((f"(host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '{slash}{rest}')", rule, verdict))
    case = lambda i: "CASE " + " ".join(f"WHEN {f[0]} THEN '{f[i]}'" for f in fits) + " END"
    link = LINK.replace("'", "''")
    parts = [f"""
WITH cutoff AS (
  SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), named AS (
  SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cutoff
), facts AS MATERIALIZED (
  SELECT page_id, host, path, {case(1)} AS rule, {case(2)} AS said,
         list_distinct(list_transform(regexp_extract_all(coalesce(html, ''), '{link}', 1), lambda x: translate(x, '{UPPER}', '{LOWER}'))) AS links
  FROM named
), links AS (
  SELECT a, b, count(*)::DOUBLE AS weight FROM (SELECT host AS a, unnest(links) AS b FROM facts) WHERE a <> '' AND a <> b GROUP BY a, b
), names AS (
  SELECT host FROM facts WHERE host <> '' UNION SELECT b FROM links
), chain AS (
  SELECT string_split(host, '.') AS l, unnest(range(1, greatest(len(string_split(host, '.')) - 1, 1))) AS i FROM names
), up AS (
  SELECT DISTINCT array_to_string(l[i:], '.') AS a, array_to_string(l[i + 1:], '.') AS b FROM chain
), edges AS MATERIALIZED (
  SELECT a, b, sum(weight) AS weight
  FROM (SELECT * FROM links UNION ALL SELECT a, b, 1.0 FROM up UNION ALL SELECT b, a, 1.0 FROM up) GROUP BY a, b
), flows AS MATERIALIZED (
  SELECT 'trust' AS kind, a AS host, b AS dest, weight / sum(weight) OVER (PARTITION BY a) AS share FROM edges
  UNION ALL SELECT 'distrust', b, a, weight / sum(weight) OVER (PARTITION BY b) FROM edges
), seeds AS (
  SELECT CASE WHEN said = 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, count(*) AS n
  FROM facts WHERE host <> '' AND said IS NOT NULL GROUP BY ALL
), start AS MATERIALIZED (
  SELECT kind, host, n / sum(n) OVER (PARTITION BY kind) AS rank FROM seeds
), r0 AS (SELECT * FROM start)"""]
    parts += [f""", r{i} AS MATERIALIZED (
  SELECT kind, host, sum(rank) AS rank FROM (
    SELECT f.kind, f.dest AS host, r.rank * f.share * {DAMPING} AS rank FROM flows f JOIN r{i - 1} r ON r.kind = f.kind AND r.host = f.host
    UNION ALL SELECT kind, host, rank * (1 - {DAMPING}) FROM start) GROUP BY kind, host
)""" for i in range(1, STEPS + 1)]
    return "".join(parts) + f""", scored AS (
  SELECT host, sum(CASE WHEN kind = 'trust' THEN part ELSE 0 END) AS trust, sum(CASE WHEN kind = 'distrust' THEN part ELSE 0 END) AS distrust
  FROM (SELECT kind, host, rank / sum(rank) OVER (PARTITION BY kind) AS part FROM r{STEPS}) GROUP BY host
)
SELECT f.page_id, f.host, f.path, f.rule,
       coalesce(f.said, CASE WHEN s.distrust > s.trust * {RATIO} + 1e-12 THEN 'block' ELSE 'allow' END) AS verdict
FROM facts f LEFT JOIN scored s ON s.host = f.host
"""


ORACLE = _oracle()
