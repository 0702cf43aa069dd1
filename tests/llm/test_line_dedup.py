"""Line keys, cuts and bitmaps against plain Python."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest

from payrisk.llm import line_dedup
from payrisk.session import setting

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_docs=10, keep_first=False):
    """(n_lines, n_dropped, kept) of each row (doc_id, text)."""
    lines = [(text or "").split("\n") for _, text in rows]
    keys = [[x.strip(" \t\n\x0b\x0c\r").translate(UPPER) for x in own] for own in lines]
    where = defaultdict(set)
    first = {}
    for (doc_id, text), own in zip(rows, keys):
        for place, key in enumerate(own):
            where[key].add((doc_id, text if doc_id is None else ""))
            first[key] = min(first.get(key, (10**9, 0)), (doc_id or -1, place))
    common = {k for k, docs in where.items() if k and len(docs) >= min_docs}
    out = []
    for (doc_id, _), own, body in zip(rows, keys, lines):
        gone = [
            k in common and not (keep_first and first[k] == (doc_id or -1, place))
            for place, k in enumerate(own)
        ]
        out.append((len(own), sum(gone), "\n".join(x for x, g in zip(body, gone) if not g)))
    return out


def found(frame, **how):
    kept = line_dedup.kept_texts(frame, line_dedup.keep_bitmaps(frame, **how))
    return sorted((r["n_lines"], r["n_dropped"], r["text"]) for r in kept.collect())


def test_query_equals_plain(run_query, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    want = {d: (n, k, hashlib.sha256(t.encode()).hexdigest()) for (d, _), (n, k, t) in zip(rows, plain(rows))}
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in run_query(13).collect()}
    assert got == want
    assert any(k for _, k, _ in got.values())


@pytest.fixture(scope="module")
def crowded(spark):
    """A line in a third of all rows, lines near the threshold, repeats within documents."""
    pick = random.Random(7)
    rows = []
    for doc in range(400):
        lines = [f"Line {pick.randrange(60)}" for _ in range(pick.randrange(8))]
        lines += [pick.choice(["Common", " common\t", "COMMON"])] * pick.randrange(1, 4)
        lines += ["", " ", f"own {doc}"] + [f"rare {doc // 9}", f"tenth {doc // 10}"]
        pick.shuffle(lines)
        rows.append((doc, "\n".join(lines)))
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(7)


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("partitions", [1, 6, 150])
def test_cuts_lose_nothing(spark, crowded, partitions, keep_first):
    """Many ranges cut through the common line; some leave fewer than ten documents on a side."""
    rows, frame = crowded
    with (
        setting(spark, "spark.sql.shuffle.partitions", str(partitions)),
        setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"),
        setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "16"),
    ):
        assert found(frame, keep_first=keep_first) == sorted(plain(rows, 10, keep_first))


def test_lowest_threshold(spark):
    rows = [(1, "a\nb\na"), (2, "b"), (3, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for least in (1, 2):
        assert found(frame, min_docs=least) == sorted(plain(rows, least))
    with pytest.raises(ValueError, match="min_docs"):
        line_dedup.keep_bitmaps(frame, min_docs=0)


def test_repeats_count_once(spark):
    """Rows that share an id are one document; nameless rows are told apart by their text."""
    same = [(1, "x\nown")] * 10
    assert found(spark.createDataFrame(same, "doc_id long, text string")) == sorted(plain(same))
    other = [(None, f"x\n{i}") for i in range(10)]
    got = found(spark.createDataFrame(other, "doc_id long, text string"))
    assert got == sorted(plain(other)) and all(n == 1 for _, n, _ in got)


def test_odd_rows(spark, odd_documents, no_documents):
    kept = line_dedup.kept_texts(odd_documents, line_dedup.keep_bitmaps(odd_documents, min_docs=2))
    rows = kept.collect()
    assert len(rows) == odd_documents.count()
    assert set(odd_documents.columns) <= set(kept.columns)
    nameless = [r for r in rows if r["doc_id"] is None]
    assert sorted((r["n_lines"], r["text"]) for r in nameless) == [(1, ""), (1, "Nobody's text é 😀")]
    assert {(r["n_dropped"], r["text"]) for r in rows if r["doc_id"] in (5, 6)} == {(1, "")}
    assert line_dedup.kept_texts(no_documents, line_dedup.keep_bitmaps(no_documents)).count() == 0


def test_long_text_of_many_lines(spark):
    rows = [(i, "\n".join(f"shared {k % 5000}" for k in range(20_000)) + f"\n{i}") for i in range(10)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(frame) == sorted((20_001, 20_000, str(i)) for i in range(10))
    bitmap = line_dedup.keep_bitmaps(frame).first()
    assert len(bitmap["keep"]) < 100
