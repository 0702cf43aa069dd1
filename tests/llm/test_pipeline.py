"""The pipeline's stages, and the whole against a plain run."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from payrisk.llm import pii, quality
from tests.conftest import SF
from tests.llm.test_decontam import plain
from tests.llm.test_packing import check_round_trip, check_sequences
from tests.llm.test_pii import plain_spans
from tests.llm.test_simhash import plain_components, plain_fingerprint

STAGES = dict(corpus_pipeline.STAGES)


def test_run_equals_a_plain_run(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = quality.fit(documents, labels, held)
    good = quality.score(documents.select("doc_id", "text"), model).filter(
        F.col("score") >= corpus_pipeline.QUALITY
    )
    kept = {r["doc_id"] for r in good.collect()}
    texts = {r["doc_id"]: r["text"] for r in documents.collect() if r["doc_id"] in kept}
    roots = plain_components({i: plain_fingerprint(t) for i, t in texts.items()})
    texts = {i: t for i, t in texts.items() if roots[i] == i}
    texts = {i: texts[i] for i, _, n_hit, _ in plain(list(texts.items()), items) if not n_hit}
    masked = {}
    for i, text in texts.items():
        out, done = [], 0
        for kind, start, end in plain_spans(text):
            if start >= done:
                out += [text[done:start], f"[{kind.upper()}]"]
            done = max(done, end)
        masked[i] = "".join([*out, text[done:]])
    assert 0 < len(masked) < len(kept) < documents.count()
    rows = corpus_pipeline.run(spark, SF).collect()
    check_round_trip(rows, masked, Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")))
    check_sequences(rows)


def test_stages_are_as_dealt():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "pii", "packing"]


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_with_odd_and_no_rows(spark, name, odd_documents, no_documents):
    frame = odd_documents.withColumn("n_chars", F.length("text").cast("long")).withColumn("lang", F.lit("en"))
    for docs, n in ((frame, frame.count()), (frame.limit(0), 0)):
        out = STAGES[name](spark, docs, SF)
        assert out.count() <= max(n, 3 * n)
        if name != "packing":
            assert out.columns == docs.columns


def test_masked_documents_keep_their_rows(spark, documents):
    out = STAGES["pii"](spark, documents, SF)
    assert out.columns == documents.columns and out.count() == documents.count()
    assert out.filter(F.length("text") != F.col("n_chars")).count() == 0
    assert not any(pii.base_spans(r["text"]) for r in out.collect())
