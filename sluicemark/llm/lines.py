"""Remove lines that are spread over many sites.

Every line is hashed after trimming white space, and a HyperLogLog sketch of the sites it is on is
built per hash, merged by aggregation, so a line that is everywhere costs one sketch per task.
Lines whose estimate lies within ``band`` of the threshold get an exact distinct count.  The threshold depends on a line's words: a
long one that two sites share is hardly chance, a short one may be, see ``MIN_SITES``.  A line on as many sites or more is boilerplate: it stays where it comes first (smallest document id,
then position) and is removed everywhere else.

Only DataFrame operations are used.  What is shuffled per line is its hash and place, never its
text.  Joins put a unique table of boilerplate hashes against lines, so a hot line can be split.

Blank lines and lines of fewer than ``min_words`` words are never removed.  Null text stays null and
has no lines; a null source is no site, but its lines are removed like others.  Repeated rows
(same id and text) are treated alike.  A very long text is split in one task, in time and memory proportional to it.  An empty table gives no rows.  Other columns are kept; one with
the name of an added column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicemark.session import staged

# Words from which, and sites on which, a line is boilerplate; the first that fits counts.
MIN_SITES = ((50, 3), (20, 6), (0, 10))
MIN_WORDS = 3
BAND = 0.25
LG_K = 12
ADDED = ("n_lines", "n_removed", "words_removed")
WHITE = " \t\n\x0b\f\r"


def _split(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _text_key(text: Column) -> Column:
    return F.xxhash64(text)


def placed_lines(docs: DataFrame, doc_id: str, text: str, source: str, min_words: int) -> DataFrame:
    """(doc, text_key, site, pos, line, words) of every line long enough, ``line`` being its hash."""
    rows = docs.select(
        F.col(doc_id).alias("doc"), _text_key(F.col(text)).alias("text_key"), F.col(source).alias("site"), F.posexplode(_split(F.col(text))).alias("pos", "raw")
    )
    trimmed = rows.withColumn("raw", F.btrim("raw", F.lit(WHITE)))
    words = F.when(F.col("raw") == "", 0).otherwise(F.size(F.split("raw", r"[\x20\x09-\x0D]+")))
    counted = trimmed.withColumn("words", words).filter(F.col("words") >= min_words)
    return counted.select("doc", "text_key", "site", "pos", F.xxhash64("raw").alias("line"), "words")


def sites_needed(words: Column, min_sites: tuple[tuple[int, int], ...] = MIN_SITES) -> Column:
    found = None
    for least, sites in sorted(min_sites, reverse=True):
        found = F.when(words >= least, sites) if found is None else found.when(words >= least, sites)
    return found


def boilerplate(lines: DataFrame, min_sites: tuple[tuple[int, int], ...] = MIN_SITES, band: float = BAND) -> DataFrame:
    """(line, first) of the hashes on as many sites as their words ask for; ``first`` is (doc, pos)."""
    sketched = lines.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("spread"), F.min(F.struct("doc", "pos")).alias("first"), F.max("words").alias("words")
    ).withColumn("needed", sites_needed(F.col("words"), min_sites))
    likely = staged(sketched.filter(F.col("spread") >= F.col("needed") * (1 - band)))
    near = likely.filter(F.col("spread") < F.col("needed") * (1 + band))
    exact = (
        lines.join(near.select("line", "needed"), "line")
        .groupBy("line", "needed").agg(F.count_distinct("site").alias("sites")).filter(F.col("sites") >= F.col("needed"))
    )
    sure = likely.filter(F.col("spread") >= F.col("needed") * (1 + band))
    return staged(sure.unionByName(near.join(exact.select("line"), "line", "left_semi")).select("line", "first"))


def drop_spread_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    min_sites: tuple[tuple[int, int], ...] | int = MIN_SITES,
    min_words: int = MIN_WORDS,
    band: float = BAND,
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of the text, and n_lines, n_removed, words_removed."""
    min_sites = ((0, min_sites),) if isinstance(min_sites, int) else min_sites
    lines = staged(placed_lines(docs, doc_id, text, source, min_words))
    found = lines.join(boilerplate(lines, min_sites, band), "line")
    again = ~F.struct("doc", "pos").eqNullSafe(F.col("first"))
    gone = (
        found.filter(again).select("doc", "text_key", "pos", "words").distinct()
        .groupBy("doc", "text_key").agg(F.collect_list("pos").alias("gone"), F.sum("words").alias("words_removed"))
    )
    kept_columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(kept_columns, F.col(doc_id).alias("doc"), _text_key(F.col(text)).alias("text_key"))
    gone = gone.withColumnsRenamed({"doc": "gone_doc", "text_key": "gone_key"})
    same = F.col("doc").eqNullSafe(F.col("gone_doc")) & (F.col("text_key") == F.col("gone_key"))
    # The one-element explode keeps the split from being worked out again for every line taken from it.
    joined = keyed.join(gone, same, "left").select("row", "gone", "words_removed", F.explode(F.array(_split(F.col(f"row.`{text}`")))).alias("parts"))
    old = F.col(f"row.`{text}`")
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("gone")), lambda i: F.get("parts", i))
    new = F.when(F.col("gone").isNull(), old).otherwise(F.array_join(left, "\n"))
    columns = [new.alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns if c.lower() not in ADDED]
    counts = [
        F.coalesce(F.size("parts"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("words_removed", F.lit(0)).cast("long").alias("words_removed"),
    ]
    return joined.select(*columns, *counts)


ORACLE = """
WITH raw AS (
  SELECT doc_id, source, text, string_split(text, chr(10)) AS parts FROM documents
), lines AS (
  SELECT doc_id, source, generate_subscripts(parts, 1) AS pos, unnest(parts) AS raw FROM raw
), trimmed AS (
  SELECT doc_id, source, pos, raw, trim(raw, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line FROM lines
), counted AS (
  SELECT *, CASE WHEN line = '' THEN 0 ELSE len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) END AS words FROM trimmed
), spread AS (
  SELECT line, count(DISTINCT source) AS sites, min(struct_pack(d := doc_id, p := pos)) AS first
  FROM counted WHERE words >= {min_words} GROUP BY line HAVING count(DISTINCT source) >= CASE {needed} END
), marked AS (
  SELECT c.*, s.line IS NOT NULL AND NOT (s.first.d = c.doc_id AND s.first.p = c.pos) AS gone
  FROM counted c LEFT JOIN spread s ON s.line = c.line AND c.words >= {min_words}
), whole AS (
  SELECT doc_id, coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text,
         count(*) AS n_lines, coalesce(sum(CASE WHEN gone THEN 1 ELSE 0 END), 0)::BIGINT AS n_removed,
         coalesce(sum(CASE WHEN gone THEN words ELSE 0 END), 0)::BIGINT AS words_removed
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, d.source, CASE WHEN d.text IS NULL THEN NULL ELSE w.text END AS text,
       coalesce(w.n_lines, 0) AS n_lines, coalesce(w.n_removed, 0) AS n_removed, coalesce(w.words_removed, 0) AS words_removed
FROM documents d LEFT JOIN whole w ON w.doc_id = d.doc_id
""".format(needed=" ".join(f"WHEN max(words) >= {w} THEN {n}" for w, n in MIN_SITES), min_words=MIN_WORDS)
