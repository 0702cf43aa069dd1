"""Base spans against plain patterns, and patterns learnt from planted contexts."""

from __future__ import annotations

import hashlib
import random
import re

from payrisk.llm import pii

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    def good(kind, m):
        digits = re.sub("[^0-9]", "", m.group())
        if kind == "ip":
            return all(int(p) <= 255 for p in m.group().split("."))
        if kind == "card":
            twice = [int(d) * 2 for d in digits[-2::-2]]
            total = sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in twice)
            return 12 <= len(digits) <= 19 and total % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    found = [
        (kind, m.start(), m.end()) for kind, p in PLAIN.items() for m in p.finditer(text) if good(kind, m)
    ]
    return sorted(found, key=lambda x: (x[1], list(PLAIN).index(x[0])))


def test_random_texts_equal_plain_patterns():
    pick = random.Random(1)
    pieces = ["1", "23", "4.", "255.", "@", "a", ".", "-", " ", "+", "(", ")", "com", "4111 1111", "é", "0"]
    for _ in range(20_000):
        text = "".join(pick.choice(pieces) for _ in range(pick.randint(1, 40)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_long_runs_take_linear_time():
    text = "1" * 200_000 + " " + "a" * 200_000 + "@" + "1." * 50_000 + "+1" + " " * 50_000
    assert pii.base_spans(text) is not None


def test_query(run_query, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    rows = run_query(7).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = plain_spans(texts[r["doc_id"]])
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert set(listed.split(",")) <= set(r["spans"].split(","))
        for kind in PLAIN:
            assert r[f"n_{kind}"] == sum(k == kind for k, _, _ in spans)


def _planted(spark):
    rows = []
    for i in range(300):
        known = f"reach me at u{i}@mail{i % 7}.example.com now"
        unknown = f"please reach me at AB{i:05d}K then"
        other = f"part number {i:05d}X the the the"
        rows.append((i, f"some words {other} and {known if i % 2 else unknown}"))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_patterns_of_seeds_find_unseen_identifiers(spark):
    docs = _planted(spark)
    patterns = pii.learn_patterns(docs.select("text"))
    assert "reach me at" in patterns and not {"part number", "the"} & set(patterns)
    spans = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in pii.find(docs, patterns).collect()}
    assert all(spans[i] == (["email"] if i % 2 else [pii.FOUND]) for i in spans)
    texts = {r["doc_id"]: r["text"] for r in pii.redact(docs, patterns).collect()}
    assert texts[1].endswith("reach me at [EMAIL] now") and texts[0].endswith("at [FOUND] then")
    assert "00000X" in texts[0]


def test_pattern_keys_are_those_of_their_occurrences(spark):
    texts = spark.createDataFrame([("One two, three one TWO",), (None,), ("two one two",)], "text string")
    import numpy as np

    keys = np.array(sorted(pii.pattern_hash(p) for p in ("one two", "two")), dtype=np.uint64)
    batches = [b for b in texts.toArrow().to_batches()]
    out = [r for b in pii._occurrences(iter(batches), keys) for r in b.to_pylist()]
    counts = {}
    for r in out:
        counts[r["key"] % (1 << 64)] = counts.get(r["key"] % (1 << 64), 0) + r["n"]
    assert counts == {pii.pattern_hash("one two"): 3, pii.pattern_hash("two"): 4}


def test_odd_rows(odd_documents, no_documents):
    assert pii.learn_patterns(odd_documents.select("text")) == []
    found = pii.find(odd_documents, ["here twice"])
    assert found.count() == odd_documents.count() and found.columns[-1] == "spans"
    masked = pii.redact(odd_documents, [])
    assert masked.columns == odd_documents.columns
    assert masked.exceptAll(odd_documents).count() == 0 and masked.count() == odd_documents.count()
    assert pii.learn_patterns(no_documents.select("text")) == []
    assert pii.find(no_documents, []).count() == pii.redact(no_documents, []).count() == 0


def test_rare_contexts_are_learnt_among_many_numbers(spark):
    """60 000 part numbers in other texts do not hide a context of 20 identifiers."""
    rows = [(i, " ".join(f"lot {i:03d}{j:05d}" for j in range(1500))) for i in range(40)]
    for i in range(20):
        name = f"u{i}@mail.example.com" if i % 2 else f"AB{i:05d}K"
        rows.append((100 + i, f"please write to {name} then"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    patterns = pii.learn_patterns(docs.select("text"))
    assert "please write to" in patterns and "lot" not in patterns
    spans = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in pii.find(docs, patterns).collect()}
    assert all(spans[100 + i] == (["email"] if i % 2 else [pii.FOUND]) for i in range(20))
    assert not spans[0]


def test_words_of_contexts_are_whole():
    """However long the words before an identifier and the gaps between them are."""
    pick = random.Random(8)
    for _ in range(300):
        parts = [pick.choice("aBé9") * pick.choice([1, 5, 60, 118, 119, 120, 121, 500]) for _ in range(pick.randrange(6))]
        before = "".join(p + pick.choice([" ", ", ", "." * 130, "\n" * 700]) for p in parts)
        words = [w.translate(pii._FOLD) for w in pii._WORD.findall(before)][-3:]
        want = [" ".join(words[-n:]) for n in range(1, len(words) + 1)]
        assert pii.contexts(before + "4711-0815", len(before)) == want
    long = "a" * 60 + " " + "b" * 40 + " " + "c" * 30 + " "
    assert pii.contexts(long + "4711", len(long))[-1] == long.strip()
