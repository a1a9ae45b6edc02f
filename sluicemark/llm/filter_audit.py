"""Interaction audit of document filters, by recursive enumeration of their orders.

Every document is reduced to a mask of the filters it fails.  Per part (a source), documents are counted by mask: a cell holds
how many there are, how many are of good quality and how many are toxic.  A recursive query then starts from the empty prefix of
every part and extends it by each filter not used yet; it joins the part's cells, carries the bits applied so far
and emits the figures of that step, so 325 rows a part stand for all 120 orders of five filters.

What is read from texts are numbers; texts are known by their SHA-256.  Rows of one id, label and text are summed first, then those of one text
on the map side, so a text that is everywhere costs one row per task and part.  Cells are at most 32 a part and are
written once, so that a recursion level reads them and not the documents; only a part's cells, never its documents, are gathered into a row.

Null text is empty, a null source is the part ''.  A document without id is no copy of another and others are no copies of it; rows that
repeat an id with the same text are not copies of each other.  Of repeated labels the largest counts; a missing label is neither good
nor toxic.  Ties do not arise.  Very long texts are counted in the JVM, in memory proportional to one text.  An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicemark.session import staged

FILTERS = "ABCDE"
COPY = "E"
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def failures(text: Column) -> dict[str, Column]:
    """The filters that look at one text: too short, repetitive, shouting, symbols."""
    # A split leaves an empty word at either end where white space is.
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, distinct = F.size(words).alias("n"), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {"A": n < 50, "B": 100 * distinct < 65 * n, "C": 100 * capitals > 5 * F.length(text), "D": text.rlike(r"[#$%&*|]")}


def _bit(name: str) -> int:
    return 1 << FILTERS.index(name)


def masked(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """(text_key, doc, part, mask, good, toxic, n): rows of one document with one text, their mask without the copy filter."""
    said = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc"), F.coalesce(F.col(source), F.lit("")).alias("part"), F.unhex(F.sha2(said.cast("binary"), 256)).alias("text_key"),
        sum((F.when(failed, _bit(name)).otherwise(0) for name, failed in failures(said).items()), F.lit(0)).alias("mask"),
    )
    known = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("label_doc")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    none = F.lit(False)
    counted = rows.filter("doc IS NOT NULL").join(known, F.col("doc") == F.col("label_doc"), "left").select(
        "text_key", "doc", "part", "mask", F.coalesce("good", none).alias("good"), F.coalesce("toxic", none).alias("toxic")
    ).groupBy("doc", "text_key", "part", "mask", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))
    nameless = rows.filter("doc IS NULL").groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"))
    return counted.unionByName(nameless.withColumns({"good": none, "toxic": none}), allowMissingColumns=True)


def cells(rows: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic) with the copy filter's bit, from the rows of ``masked``."""
    named = rows.filter("doc IS NOT NULL")
    # Ids are distinct in these rows, so those of the smallest one are told from the rest by their count.
    by_text = named.groupBy("text_key", "part", "mask", "good", "toxic").agg(F.sum("n").alias("n"), F.min("doc").alias("first"), F.min_by("n", "doc").alias("n_first"))
    first = F.min("first").over(Window.partitionBy("text_key"))
    originals = F.when(F.col("first") == F.col("least"), F.col("n_first")).otherwise(0)
    split = by_text.withColumn("least", first).select(
        "part", "good", "toxic",
        F.inline(F.array(
            F.struct(F.col("mask").alias("mask"), originals.alias("n")), F.struct((F.col("mask") + _bit(COPY)).alias("mask"), (F.col("n") - originals).alias("n"))
        )),
    )
    every = split.unionByName(rows.filter("doc IS NULL").select("part", "good", "toxic", "mask", "n"))
    return every.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic")
    ).filter("n > 0")


RECURSION = """
WITH RECURSIVE steps (part, prefix, applied, kept, removed, redundant, unique_fails, good_lost, toxic_lost) MAX RECURSION LEVEL 10 AS (
  SELECT part, '', 0, 0L, 0L, 0L, 0L, 0L, 0L FROM {parts}
  UNION ALL
  SELECT part, prefix || letter, applied | bit,
         aggregate(cells, 0L, (s, c) -> s + IF(c.mask & (applied | bit) = 0, c.n, 0L)),
         aggregate(cells, 0L, (s, c) -> s + IF(c.mask & bit != 0 AND c.mask & applied = 0, c.n, 0L)),
         aggregate(cells, 0L, (s, c) -> s + IF(c.mask & bit != 0 AND c.mask & applied != 0, c.n, 0L)),
         aggregate(cells, 0L, (s, c) -> s + IF(c.mask = bit, c.n, 0L)),
         aggregate(cells, 0L, (s, c) -> s + IF(c.mask & bit != 0 AND c.mask & applied = 0, c.good, 0L)),
         aggregate(cells, 0L, (s, c) -> s + IF(c.mask & bit != 0 AND c.mask & applied = 0, c.toxic, 0L))
  FROM (SELECT s.part, s.prefix, s.applied, c.cells, explode(filter(c.letters, l -> s.applied & l.bit = 0)) AS next
        FROM steps s JOIN {parts} c ON s.part = c.part) LATERAL VIEW inline(array(next)) AS letter, bit
)
SELECT * FROM steps WHERE prefix != ''
"""


def enumerate_orders(counted: DataFrame) -> DataFrame:
    """One row per part and prefix of an order, with the figures of the prefix's last step."""
    spark = counted.sparkSession
    letters = F.array(*[F.struct(F.lit(name).alias("letter"), F.lit(_bit(name)).alias("bit")) for name in FILTERS])
    gathered = staged(counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")).withColumn("letters", letters))
    before = spark.conf.get(_ROW_LIMIT)
    # The limit guards against endless recursion; here the levels are as many as the filters, whatever the number of parts.
    spark.conf.set(_ROW_LIMIT, -1)
    try:
        return staged(spark.sql(RECURSION, parts=gathered))
    finally:
        spark.conf.set(_ROW_LIMIT, before)


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per part, order of the filters and step."""
    steps = enumerate_orders(staged(cells(staged(masked(docs, labels, doc_id, text, source)))))
    orders = ["".join(p) for p in permutations(FILTERS)]
    spelled = docs.sparkSession.createDataFrame(  # 600 rows
        [(order[:k], order, k) for order in orders for k in range(1, len(FILTERS) + 1)], "prefix string, filter_order string, step int"
    )
    every = steps.join(F.broadcast(spelled), "prefix")
    shapley = F.sum("removed").over(Window.partitionBy("part", F.substring("prefix", -1, 1)))
    return every.select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", shapley.alias("shapley")
    )


ORACLE = r"""
WITH said AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), first AS (
  SELECT text, min(doc_id) AS doc_id FROM said GROUP BY text
), worded AS (
  SELECT s.*, coalesce(f.doc_id < s.doc_id, false) AS copy, regexp_extract_all(s.text, '[^\x20\x09-\x0D]+') AS words FROM said s JOIN first f USING (text)
), label AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (CASE WHEN len(words) < 50 THEN 'A' ELSE '' END)
         || (CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END)
         || (CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text) THEN 'C' ELSE '' END)
         || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
         || (CASE WHEN copy THEN 'E' ELSE '' END) AS fails
  FROM worded LEFT JOIN label USING (doc_id)
), cells AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, fails
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), steps AS (
  SELECT filter_order, step::INT AS step, filter_order[step] AS f, left(filter_order, step - 1) AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), figures AS (
  SELECT part, filter_order, step, f,
         coalesce(sum(n) FILTER (fails = translate(fails, before || f, '')), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (contains(fails, f) AND fails = translate(fails, before, '')), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (contains(fails, f) AND fails != translate(fails, before, '')), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (fails = f), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (contains(fails, f) AND fails = translate(fails, before, '')), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (contains(fails, f) AND fails = translate(fails, before, '')), 0)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM figures
"""
