"""The registered queries: each applies one operator, with its production parameters, to whole
tables and derives the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payrisk.llm import (
    ann,
    centroids,
    decontam,
    html,
    line_dedup,
    lm,
    packing,
    pii,
    prefix_trie,
    quality,
    secrets,
    simhash,
    toxicity,
)
from payrisk.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(folds: int) -> Column:
    """The fold that contracts hold out: crc32 of the id as text."""
    return F.crc32(F.col("doc_id").cast("string")) % folds == 1


def _predicted(scored: DataFrame, least: float) -> DataFrame:
    return scored.select(
        "doc_id",
        F.coalesce(_fold(3), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= least).cast("int").alias("predicted"),
    )


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract_pages(pages).withColumn("n_chars", F.length("text").cast("long"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"), _fold(3))
    return _predicted(toxicity.score(docs, model), 0.7)


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontam.contaminated(docs, items).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _listed(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
    )


def _count_of(kind: str) -> Column:
    # One argument: a second one would be the place in the array.
    return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")


def _span_digest(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Counts of the base kinds, the digest of ``base`` and the list of ``spans``."""
    return found.select(
        "doc_id",
        *(_count_of(kind) for kind in kinds),
        F.sha2(_listed("base"), 256).alias("base_sha256"),
        _listed("spans").alias("spans"),
    )


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return _span_digest(secrets.find(docs), secrets.KINDS)


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_table(spark, sf_dir, "documents"), _fold(5))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"), _fold(3))
    return _predicted(quality.score(docs, model), 0.5)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.learn_patterns(docs.select("text")))
    base = F.filter("spans", lambda x: x["kind"] != pii.FOUND)
    return _span_digest(found.withColumn("base", base), pii.KINDS)


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(_table(spark, sf_dir, "documents"), path)


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    return prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(turns)))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(_table(spark, sf_dir, "embeddings"))
    text = F.array_join(F.transform("centroid", lambda x: x.cast("string")), ",")
    return found.withColumn("centroid_sha256", F.sha2(text, 256)).drop("centroid")


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.kept_texts(docs, line_dedup.keep_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_toxicity": op2_toxicity,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_secret_scans": op4_secret_scans,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_pii": op7_pii,
    "op8_nearest_neighbours": op8_nearest_neighbours,
    "op9_packing": op9_packing,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_line_dedup": op13_line_dedup,
}
