"""A corpus pipeline: keep good documents once each, without test items and personal data, packed.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; between stages
the documents are written as Parquet and read again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payrisk.llm import decontam, packing, pii, quality, simhash
from payrisk.session import scratch_path

#: Documents of a lower quality score go.
QUALITY = 0.5


def _good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. It learns from the labelled ones that are
    not held out; a document's own label, language or source is not looked at."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = quality.fit(docs, labels, held_out)
    return quality.keep(docs, model, QUALITY)


def _once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def _clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontam.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked; n_chars is that of the new text."""
    patterns = pii.learn_patterns(docs.select("text"))
    masked = pii.redact(docs, patterns)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def _packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", _good),
    ("simhash_near_dedup", _once),
    ("benchmark_decontamination", _clean),
    ("pii", _masked),
    ("packing", _packed),
]

#: SQL cannot state a trained classifier; the tests compare with a brute-force run.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
