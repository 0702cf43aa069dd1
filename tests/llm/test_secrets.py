"""Base spans against plain patterns, and the two character models."""

from __future__ import annotations

import hashlib
import random
import re

from payrisk.llm import secrets

KINDS = ("assign", "access", "hex")
PLAIN = {
    "assign": re.compile(
        r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A
    ),
    "access": re.compile("AKIA[A-Z0-9]+"),
    "hex": re.compile("[0-9a-f]+"),
}


def plain_spans(text: str | None) -> list[tuple[str, int, int]]:
    def good(kind, m):
        return len(m.group(2)) >= 6 if kind == "assign" else len(m.group()) >= (20 if kind == "access" else 24)

    found = [
        (kind, m.start(), m.end()) for kind, p in PLAIN.items() for m in p.finditer(text or "") if good(kind, m)
    ]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def _base(row):
    return [(s["kind"], s["start"], s["end"]) for s in row["base"]]


def test_random_texts_equal_plain_patterns(spark):
    pick = random.Random(2)
    pieces = [
        "token", "=", ":", " ", "'", '"', "password", "api_key", "APIkey", "é", "😀", "abc", "0f3e" * 7,
        "AKIA", "ABCDEFGH01234567", "xyz", "\n", "sk_live_9aZ8bY7cX6dW5eV4", "-",
    ]
    rows = [(i, "".join(pick.choice(pieces) for _ in range(pick.randint(0, 25)))) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    for r in secrets.find(docs).collect():
        assert _base(r) == plain_spans(texts[r["doc_id"]]), texts[r["doc_id"]]
        spans = [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == secrets.RANDOM]
        assert not any(s < b[2] and e > b[1] for s, e in spans for b in _base(r))


def test_query(run_query, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    rows = run_query(4).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = plain_spans(texts[r["doc_id"]])
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[0] == k for s in spans) for k in KINDS]


def test_models_tell_random_strings_from_identifiers(spark):
    pick = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    random_token = lambda n: "".join(pick.choice(letters) for _ in range(n))
    words = "customer payment number reference account handler message version update value index".split()
    labelled = [(random_token(24), 1) for _ in range(2000)]
    labelled += [("_".join(pick.choice(words) for _ in range(4)), 0) for _ in range(2000)]
    ratio = secrets.train(spark.createDataFrame(labelled, "token string, label int"))
    keys = [random_token(32) for _ in range(50)]
    names = ["-".join(pick.choice(words) for _ in range(4)) + "-2024" for _ in range(50)]
    rows = [(i, f"see {t} there") for i, t in enumerate(keys + names)]
    found = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string"), ratio).collect()
    caught = {r["doc_id"] for r in found if r["spans"]}
    assert len(caught & set(range(50))) >= 48 and len(caught & set(range(50, 100))) <= 1


def test_long_tokens_are_scored_whole(spark):
    """A token of many pieces scores as the mean over all its pairs."""
    ratio = [0.0] * len(secrets.ALPHABET) ** 2
    at = secrets.ALPHABET.index
    ratio[at("a") * len(secrets.ALPHABET) + at("1")] = 1.0
    token = "a1" * 1000
    frame = spark.createDataFrame([(token,)], "t string")
    assert frame.selectExpr(secrets._score("t", ratio) + " AS s").first()["s"] == 1000 / 1999


def test_no_python_in_the_plan(documents):
    plan = secrets.scan(documents, [0.0] * len(secrets.ALPHABET) ** 2)
    assert not re.search("Python|Arrow|Pandas", plan._jdf.queryExecution().executedPlan().toString())


def test_odd_rows(odd_documents, no_documents):
    rows = secrets.find(odd_documents)
    assert rows.count() == odd_documents.count() and rows.columns[-2:] == ["base", "spans"]
    assert rows.columns.count("base") == 1
    assert secrets.find(no_documents).count() == 0


def test_ordinary_sample_takes_all_words_up_to_its_size(spark):
    words = ["".join(chr(97 + (i // 26**k) % 26) for k in range(8)) for i in range(300)]
    docs = spark.createDataFrame([(" ".join(words),), (" ".join(words),)], "text string")
    count = lambda size: secrets.samples(docs, size=size).filter("label = 0").count()
    assert count(1000) == 300 and count(50) == 50


def test_the_ratio_decides_on_letters_short_tokens_and_rests(spark):
    pick = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    labelled = [("".join(pick.choice(letters) for _ in range(24)), 1) for _ in range(2000)]
    words = "customer payment number reference account handler message version update value".split()
    labelled += [("_".join(pick.choice(words) for _ in range(4)), 0) for _ in range(2000)]
    ratio = secrets.train(spark.createDataFrame(labelled, "token string, label int"))
    key, short, run = "kJhGfDsAqWeRtYuIoPzXcVbNmLqPwOeI", "xQ7zKp2Lw9TbV", "0f3e" * 6
    texts = [f"é {key} .", f"é {short} .", f"é {key}{run}{key} .", "é customer_payment_reference ."]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {
        r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == secrets.RANDOM]
        for r in secrets.scan(frame, ratio).collect()
    }
    n = len(key)
    assert found[0] == [(2, 2 + n)] and found[1] == [(2, 2 + len(short))] and found[3] == []
    assert [texts[2][s:e] for s, e in found[2]] == [key[:n], key]
