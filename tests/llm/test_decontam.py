"""Positional index: exact phrases against a dictionary of windows, and proximity."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest

from payrisk.llm import decontam
from payrisk.llm.oracle import ORACLE
from tests.conftest import SF

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain(docs, items, n=10):
    windows: dict[tuple, set] = {}
    for item, text in items:
        own = words(text)
        for i in range(max(1, len(own) - n + 1) if own else 0):
            named = {str(item)} if item is not None else set()
            windows.setdefault(tuple(own[i : i + n]), set()).update(named)
    lengths = {len(w) for w in windows}
    found = []
    for doc, text in docs:
        own, hit, seen = words(text), set(), set()
        for k in lengths:
            for i in range(len(own) - k + 1):
                if tuple(own[i : i + k]) in windows:
                    hit.update(range(i, i + k))
                    seen |= windows[tuple(own[i : i + k])]
        found.append((doc, len(own), len(hit), sorted(seen)))
    return found


def test_query_equals_plain_search(spark, run_query, documents):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    want = {r[0]: r[1:] for r in plain([(r["doc_id"], r["text"]) for r in documents.collect()], items)}
    rows = run_query(3).collect()
    assert len(rows) == len(want) and any(w[1] for w in want.values())
    for r in rows:
        n_words, n_hit, seen = want[r["doc_id"]]
        digest = hashlib.sha256(",".join(seen).encode()).hexdigest()
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == (
            n_words, n_hit, len(seen), digest, n_hit > 0,
        )


def test_query_equals_sql(duck, run_query):
    expected = duck.sql(ORACLE["op3_benchmark_decontamination"])
    rows = run_query(3)
    assert rows.columns == expected.columns
    assert sorted(tuple(r) for r in rows.collect()) == sorted(expected.fetchall())


@pytest.mark.parametrize("block", [1, 40, 10**6])
@pytest.mark.parametrize("segment", [30, 1 << 20])
def test_blocks_and_segments_change_nothing(spark, block, segment):
    docs = [
        (1, "a b c d e f a b c"), (2, "Ab a. b-c d"), (3, None), (4, ""), (None, "x y x y x y"),
        (5, "c d e f"), (5, "c d e f"), (6, "a b"), (7, "é ü é ü a"),
    ]
    items = [(10, "a b c"), (9, "c d e f a"), (8, "x y"), (7, ""), (None, "a b"), (6, "é ü"), (6, "d")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    tests = spark.createDataFrame(items, "item_id long, text string")
    index = decontam.build_index(frame, segment_bytes=segment)
    rows = decontam.find_items(index, tests, window=3, block_chars=block).collect()
    got = [(r["doc_id"], r["n_words"], r["n_hit"], list(r["items"])) for r in rows]
    key = lambda r: (str(r[0]), r[1:])
    assert sorted(got, key=key) == sorted(plain(docs, items, 3), key=key)
    for r in rows:
        assert sum(e - s for s, e in r["spans"]) == r["n_hit"]


def test_proximity(spark):
    docs = spark.createDataFrame(
        [(1, "one two three"), (2, "three x one y two"), (3, "one a b c d two e f three"), (4, "one two")],
        "doc_id long, text string",
    )
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    index = decontam.build_index(docs)

    def found(**how):
        return {r["doc_id"] for r in decontam.find_items(index, items, **how).collect() if r["n_hit"]}

    assert found() == {1}
    assert found(slop=0) == {1}
    assert found(slop=2) == {1, 2}
    assert found(slop=6) == {1, 2, 3}


def plain_near(docs, items, n, slop):
    """Words in the narrowest runs that hold a window's words as often as it has them."""
    out = []
    for doc, text in docs:
        own, hit, seen = words(text), set(), set()
        for item, item_text in items:
            all_words = words(item_text)
            for at in range(max(1, len(all_words) - n + 1) if all_words else 0):
                window = Counter(all_words[at : at + n])
                size = min(n, len(all_words)) + slop

                def holds(a, b, window=window, own=own):
                    return not window - Counter(own[a:b])

                for a in range(len(own)):
                    for b in range(a + 1, min(a + size, len(own)) + 1):
                        if holds(a, b) and not holds(a + 1, b) and not holds(a, b - 1):
                            hit.update(range(a, b))
                            seen |= {str(item)} if item is not None else set()
        out.append((doc, len(own), len(hit), sorted(seen)))
    return out


@pytest.mark.parametrize("slop", [0, 1, 4])
def test_proximity_equals_all_runs(spark, slop):
    """Small alphabets: repeated words in windows and documents, many overlapping runs."""
    pick = random.Random(slop)
    text = lambda n, letters: " ".join(pick.choice(letters) for _ in range(n))
    docs = [(i, text(pick.randrange(25), "abcd")) for i in range(40)]
    docs += [(100, "a b a b"), (101, "yes no yes"), (102, "no x no x no")]
    items = [(i, text(pick.randrange(1, 6), "abcde")) for i in range(5)] + [(8, "no no no"), (9, "a b"), (None, "d d")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(2)
    tests = spark.createDataFrame(items, "item_id long, text string")
    index = decontam.build_index(frame, segment_bytes=60)
    rows = decontam.find_items(index, tests, window=3, slop=slop).collect()
    got = sorted((r["doc_id"], r["n_words"], r["n_hit"], list(r["items"])) for r in rows)
    assert got == sorted(plain_near(docs, items, 3, slop))


def test_rows_without_item_id_hit_but_are_no_item(spark):
    docs = spark.createDataFrame([(1, "one two three four"), (2, "five")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "two three")], "item_id long, text string")
    rows = {r["doc_id"]: (r["n_hit"], r["items"]) for r in decontam.contaminated(docs, items).collect()}
    assert rows == {1: (2, []), 2: (0, [])}
    assert [r["doc_id"] for r in decontam.keep_clean(docs, items).collect()] == [2]


def test_sql_counts_rows_without_item_id():
    import duckdb

    engine = duckdb.connect()
    engine.sql("CREATE TABLE documents AS SELECT 1 AS doc_id, 'one two three four' AS text")
    engine.sql("CREATE TABLE benchmark AS SELECT NULL::BIGINT AS item_id, 'two three' AS text")
    (row,) = engine.sql(ORACLE["op3_benchmark_decontamination"]).fetchall()
    assert row == (1, 4, 2, 0, hashlib.sha256(b"").hexdigest(), True)


def test_odd_rows(spark, odd_documents, no_documents):
    items = spark.createDataFrame([(1, "text here twice"), (2, None)], "item_id long, text string")
    rows = decontam.contaminated(odd_documents, items).collect()
    assert len(rows) == odd_documents.count()
    assert sorted(r["doc_id"] for r in rows if r["n_hit"]) == [5, 5, 6]
    assert decontam.contaminated(no_documents, items).count() == 0
    none = decontam.contaminated(odd_documents, items.limit(0)).collect()
    assert len(none) == len(rows) and not any(r["n_hit"] for r in none)
    kept = decontam.keep_clean(odd_documents, items)
    assert kept.columns == odd_documents.columns and kept.count() == len(rows) - 3
