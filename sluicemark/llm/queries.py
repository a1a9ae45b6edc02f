"""Registered queries of the subpackage, each over whole tables with production parameters."""

from __future__ import annotations

from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicemark.llm import filter_audit, hnsw, hosts, languages, lines, mixing, packing, pages, pii, prefix_trie, simhash, topk, trie_model
from sluicemark.queries.registry import Query, table
from sluicemark.queries.registry import query as registered


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import the package from where the driver has it, if it isn't installed."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if root not in paths:
        env["PYTHONPATH"] = ":".join([*paths, root])


def query(name: str, sql: str | None = None):
    def register(run: Query) -> Query:
        @wraps(run)
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            on_workers(spark)
            return run(spark, sf_dir)

        return registered(name, sql)(prepared)

    return register


@query("op1_hnsw_neighbours")
def op1_hnsw_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query("op2_simhash_components")
def op2_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.components_within(docs).select(F.col("doc").alias("doc_id"), "fingerprint", F.col("component").alias("component_id"))


@query("op3_language_profiles")
def op3_language_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(languages.fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out")
    model = languages.learn(docs.filter(~held_out).select("text", "lang"))
    return languages.predict(docs.select("doc_id", held_out, "text"), model).drop("text")


@query("op4_entropy_mixing")
def op4_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs)
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken, "source", "rate", "copies")


@query("op5_threshold_topk", topk.ORACLE)
def op5_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query("op6_line_spread", lines.ORACLE)
def op6_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return lines.drop_spread_lines(docs)


@query("op7_page_blocks")
def op7_page_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


@query("op8_boosted_pii")
def op8_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    counts = [pii.count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


@query("op9_harmonic_packing")
def op9_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op10_host_graph", hosts.ORACLE)
def op10_host_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return hosts.judge(urls).select("page_id", "host", "path", "rule", "verdict")


@query("op11_prefix_trie", prefix_trie.ORACLE)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


@query("op12_filter_audit", filter_audit.ORACLE)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op13_trie_model")
def op13_trie_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = trie_model.score(table(spark, sf_dir, "documents"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
