"""Packed pieces against plain tokenization: an exact round trip, and the limits."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from payrisk.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check_sequences(rows, tokens=4096, segments=packing.MAX_SEGMENTS, loss=None):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append(r)
    padding = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= tokens and len(pieces) <= segments
        assert at & (at - 1) == 0  # a power of two needs no padding
        if loss is not None:
            assert sum(r["loss_tokens"] for r in pieces) <= loss
    return padding


def check_round_trip(rows, texts, tokenizer):
    """``rows`` hold the pieces of documents with unique ids."""
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    assert set(pieces) == set(texts)
    for i, text in texts.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        at = 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            own = np.array(ids[at : at + r["length"]], dtype="<u4")
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == zlib.crc32(own.tobytes())
            at += r["length"]
        assert at == len(ids)


def test_query_round_trip(run_query, documents, tokenizer):
    rows = run_query(9).collect()
    check_round_trip(rows, {r["doc_id"]: r["text"] for r in documents.collect()}, tokenizer)
    check_sequences(rows)


def test_texts_that_are_hard_on_chunks(spark, tokenizer):
    texts = [
        "don't <|endoftext|> a\x01b \x01 \x1c x", "Ünïcode ÀÉ İ ß é é nb sp 12 345 \n\t\r\f\v",
        "we'll they've I'm 's", "😀😀 ​ zero", "<|startoftext|>x<|endoftext|>", "́ a", "…—“q”", "", None,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packing.pack(docs, PATH).collect()
    check_round_trip(rows, dict(enumerate(texts)), tokenizer)


@pytest.mark.parametrize("limits", [(4096, 4, 4096), (1024, 512, 100), (256, 2, 64), (512, 512, 512)])
def test_all_three_limits_hold(spark, documents, limits):
    tokens, segments, loss = limits
    docs = documents.limit(60).withColumn("prompt", F.lit("Tell me something about it, please"))
    rows = packing.pack(
        docs, PATH, prompt="prompt", max_tokens=tokens, max_segments=segments, max_loss=loss, pool=16
    ).collect()
    check_sequences(rows, tokens, segments, loss)
    quiet = 7
    for r in docs.groupBy("doc_id").count().collect():
        own = [p for p in rows if p["doc_id"] == r["doc_id"]]
        assert sum(p["length"] for p in own) == own[0]["doc_tokens"]
        assert sum(p["loss_tokens"] for p in own) == own[0]["doc_tokens"] - quiet


def test_dot_product_takes_the_best_fit():
    packer = packing.Packer(16, 8, 16)
    for i, n in enumerate((9, 6, 5, 4, 3, 1)):
        packer.add([packing.Piece(i, 0, np.arange(n, dtype=np.uint32), 0, n)])
    assert [len(p.ids) for p in packer.fill()] == [9, 6, 1]


def test_odd_rows(odd_documents, no_documents):
    rows = packing.pack(odd_documents, PATH).collect()
    check_sequences(rows)
    wholes = [r for r in rows if r["start"] == 0]
    assert len(wholes) == odd_documents.count()
    assert sorted(r["doc_tokens"] for r in wholes)[:3] == [1, 1, 1]
    assert packing.pack(no_documents, PATH).count() == 0
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(no_documents, PATH, max_tokens=1000)
