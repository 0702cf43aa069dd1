"""Fingerprints, links and components against plain Python over all pairs."""

from __future__ import annotations

import random
import re

import pytest
import xxhash

from payrisk.llm import simhash


def plain_fingerprint(text: str | None) -> int:
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps: dict[int, int], radius: int = 3) -> dict[int, int]:
    ids = sorted(fps)
    name = {i: i for i in ids}

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[:k]:
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                low, high = sorted((root(a), root(b)))
                name[high] = low
    return {i: root(i) for i in ids}


def test_query_equals_all_pairs(run_query, documents):
    fps = {r["doc_id"]: plain_fingerprint(r["text"]) for r in documents.collect()}
    want = plain_components(fps)
    rows = run_query(10).collect()
    assert len(rows) == len(fps) and len(set(want.values())) < len(want)
    for r in rows:
        assert r["fingerprint"] == f"{fps[r['doc_id']]:016x}"
        assert r["component_id"] == want[r["doc_id"]]


@pytest.mark.parametrize("free", [(1 << 64) - 1, 0x0F0F_0000_FFFF_0001, 0b1111])
def test_masks_miss_no_pair(free):
    masks = simhash.covering_masks(free, 3)
    bits = [i for i in range(64) if free >> i & 1]
    pick = random.Random(1)
    for _ in range(2000):
        differing = sum(1 << b for b in pick.sample(bits, min(3, len(bits))))
        assert any(not differing & m for m in masks)
    assert all(masks)


@pytest.mark.parametrize("bucket", [8, 16, 256])
def test_dense_groups_lose_no_link(spark, bucket):
    """Buckets far beyond the limit are covered again, level after level."""
    pick = random.Random(bucket)
    base = pick.getrandbits(63)
    fps = {base}
    while len(fps) < 300:  # near copies of copies, in 14 bits
        fps.add(pick.choice(sorted(fps)) ^ 1 << pick.randrange(14))
    fps |= {pick.getrandbits(63) for _ in range(100)}
    rows = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {r["fp"]: r["root"] for r in simhash.classes(rows, 3, bucket).collect()}
    want = plain_components({f: f for f in fps})
    linked = {f for f, c in want.items() if sum(v == c for v in want.values()) > 1}
    assert got == {f: want[f] for f in linked}


def test_links_are_a_forest_not_all_pairs(spark):
    fps = spark.createDataFrame([(i,) for i in range(200)], "fp long")
    assert simhash.near_links(fps).count() < 200 * 15


def test_odd_rows(odd_documents, no_documents):
    rows = simhash.near_duplicates(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    zero = {r["doc_id"] for r in rows if r["fp"] == 0}
    assert zero == {1, 2, 3, None}
    assert {r["component_id"] for r in rows if r["fp"] == 0} == {1}
    assert {r["component_id"] for r in rows if r["doc_id"] in (5, 6)} == {5}
    lonely = [r for r in rows if r["doc_id"] is None and r["fp"] != 0]
    assert [r["component_id"] for r in lonely] == [None]
    assert simhash.near_duplicates(no_documents).count() == 0
    with pytest.raises(ValueError, match="bucket"):
        simhash.near_links(odd_documents, bucket=4)


def test_keep_one_of_each_group(odd_documents, no_documents):
    kept = simhash.keep_one(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "4", "5", "None"]
    assert simhash.keep_one(no_documents).count() == 0
