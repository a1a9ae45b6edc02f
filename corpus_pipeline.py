"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the columns of ``documents``.
The result of a stage is written as Parquet and read again as the next one's ``docs``.  Edge cases are
those of the operators; a document without an id is kept once per text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicemark.llm import languages, lines, mixing, packing, simhash
from sluicemark.llm.queries import on_workers
from sluicemark.session import staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# A text is rejected if it is nearer to no language than this quantile of texts whose language is right, or than three
# times the noise of random vectors: it is like none that was learned.
QUANTILE, NOISE = 0.001, 3 / languages.DIMENSIONS**0.5
# The score of a text with fewer letters says little; a language it is given with is believed.
LEAST_LETTERS = 50


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def _long() -> Column:
    return F.length(F.regexp_replace("text", r"[^\p{L}]+", "")) >= LEAST_LETTERS


def least_score(rated: DataFrame) -> float:
    """The score below which a text counts as none of the learned languages, from all rows rated right."""
    right = rated.filter((F.col("lang") == F.col("lang_pred")) & _long())
    return max(right.agg(F.percentile_approx("score", QUANTILE, 100_000)).first()[0] or 0.0, NOISE)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; a missing ``lang`` is filled with the prediction."""
    on_workers(spark)
    docs = _documents(docs)
    model = languages.learn(docs)
    least = least_score(languages.predict(docs.filter(F.col("lang").isNotNull()).select("text", "lang"), model))
    believed = F.col("lang").isNotNull() & ~_long()
    kept = languages.predict(docs, model).filter((F.col("lang_pred") != languages.UNKNOWN) & (believed | (F.col("score") >= least)))
    return _documents(kept.withColumn("lang", F.coalesce("lang", "lang_pred")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without boilerplate lines; those that have no word left go."""
    cleaned = lines.drop_spread_lines(_documents(docs))
    emptied = (F.col("words_removed") > 0) & (mixing.word_count(F.col("text")) == 0)
    return _documents(cleaned.filter(~emptied).withColumn("n_chars", F.length("text").cast("long")))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints are linked, the one with the smallest id."""
    on_workers(spark)
    docs = _documents(docs)
    groups = simhash.components_within(docs)
    first = groups.groupBy("group").agg(F.min(F.struct(F.col("doc").isNull().alias("nameless"), "doc", "text_key")).alias("first")).select("first.*")
    keyed = docs.withColumn("key", F.xxhash64("text"))
    kept = keyed.join(first, keyed["doc_id"].eqNullSafe(first["doc"]) & (keyed["key"] == first["text_key"]), "left_semi")
    return _documents(kept.dropDuplicates(["doc_id", "key"]))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    mixed = mixing.mix(_documents(docs)).filter(F.col("copies") > 0)
    return _documents(mixed.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, see ``packing``."""
    on_workers(spark)
    return packing.pack(_documents(docs))


STAGES = [
    ("language", identify_language),
    ("lines", dedup_lines),
    ("near_duplicates", dedup_near),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Fingerprints, learned profiles and tokens can't be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
