"""The automaton against a recursive backoff model."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from pyspark.sql import functions as F

from payrisk.llm import lm

@pytest.fixture(autouse=True)
def no_waiting(monkeypatch):
    monkeypatch.setattr(lm, "SETTLE_S", 0)


def held():
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 1


def plain(rows, word_share, ngram_share):
    lower = lambda t: re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    texts = [(i, re.findall(r"[^\x20\x09-\x0D]+", lower(t)) + [None]) for i, t in rows]
    train = [w for i, w in texts if i is None or zlib.crc32(str(i).encode()) % 5 != 1]
    c1, c2, c3 = (Counter(g for w in train for g in zip(*(w[k:] for k in range(n)))) for n in (1, 2, 3))
    total = sum(c1.values())
    size = total + 0.5 * (len(c1) + 1)
    least = max(total * ngram_share, 2)
    common = {w for (w,), n in c1.items() if n >= total * word_share}
    k2 = {g: n for g, n in c2.items() if n >= least and all(w in common for w in g)}
    k3 = {g: n for g, n in c3.items() if n >= least and g[:2] in k2 and g[1:] in k2}
    base = lambda w: math.log10((c1[w,] + 0.5) / size)
    p2 = {g: (n - lm.DISCOUNT) / c1[g[:1]] for g, n in k2.items()}
    p3 = {g: (n - lm.DISCOUNT) / k2[g[:2]] for g, n in k3.items()}
    left, rest = defaultdict(lambda: 1.0), defaultdict(lambda: 1.0)
    for g, p in p2.items():
        left[g[:1]] -= p
        rest[g[:1]] -= 10 ** base(g[1])
    for g, p in p3.items():
        left[g[:2]] -= p
        rest[g[:2]] -= p2[g[1:]]

    def logp(history, word):
        g = (*history, word)
        if len(history) == 2 and history not in k2 or len(history) == 1 and history[0] not in common:
            return logp(history[1:], word)
        if not history:
            return base(word)
        known = p3 if len(history) == 2 else p2
        if g in known:
            return math.log10(known[g])
        return math.log10(left[history] / rest[history]) + logp(history[1:], word)

    for i, w in texts:
        score = sum(logp(tuple(w[max(0, k - 2) : k]), x) for k, x in enumerate(w))
        yield i, len(w), sum(c1[x,] > 0 for x in w), total, sum(map(base, w)), score


@pytest.mark.parametrize("shares", [(1e-6, 5e-6), (2e-4, 2e-4)])
def test_scores_equal_the_recursive_model(documents, odd_documents, shares):
    docs = documents.select("doc_id", "text").unionByName(
        odd_documents.filter("doc_id is null or doc_id <> 4").select(F.col("doc_id") + 10**6, "text").toDF("doc_id", "text")
    )
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    key = lambda r: tuple(str(x) for x in r[:3]) + (round(r[4], 6),)
    want = sorted(plain(rows, *shares), key=key)
    got = sorted(
        (
            (r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"])
            for r in lm.score(docs, held(), word_share=shares[0], ngram_share=shares[1]).collect()
        ),
        key=key,
    )
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:4] == b[:4]
        assert a[4] == pytest.approx(b[4], rel=1e-9) and a[5] == pytest.approx(b[5], rel=1e-9)


def test_held_out_texts_gain_from_histories(run_query):
    row = run_query(5).agg(
        F.sum(F.when(F.col("held_out"), F.col("score") - F.col("base_score"))).alias("gain"),
        F.count("*").alias("n"),
    ).first()
    assert row["n"] == 200 and row["gain"] > 0


def test_probabilities_sum_to_one(monkeypatch):
    """Over all known words, the unknown one and the end, after each history of a small corpus: the
    rounds of messages by hand, token by token."""

    class Context:
        @staticmethod
        def get():
            return Context

        @staticmethod
        def partitionId():
            return 0

    monkeypatch.setattr(lm, "TaskContext", Context)
    histories, words = ["", "a", "b", "a b", "b a", "c", "b c"], ["a", "b", "c", "unknown"]
    texts = ["a b a b c", "a b c", "b a b"] * 5
    texts += [f"{h} {w}" for h in histories for w in words]
    batch = pa.RecordBatch.from_pydict(
        {"id": list(range(len(texts))), "held": [i >= 15 for i in range(len(texts))], "text": texts}
    )
    tokens = pa.Table.from_batches(lm._slices(iter([batch]), 1 << 24))

    def answered(messages, answer):
        parts = [messages.filter(pa.compute.equal(messages.column("bucket"), b)) for b in (0, 1)]
        return pa.concat_tables(answer(t) for t in parts if t.num_rows)

    asked = [lm._questions(iter(tokens.to_batches()), d, 1) for d in (range(2), (2,))]
    totals = answered(pa.Table.from_batches(b for part in asked for b in part), lm._totals)
    sizes = lm.Sizes(tokens.column("n_train")[0].as_py(), 4, 3, 0.0, 0.0)
    assert sum(totals.filter(pa.compute.equal(totals.column("depth"), 0)).column("n_distinct").to_pylist()) == 4
    sums = answered(lm._contributions(tokens, totals, sizes, 1), lm._sums)
    own = lm.Slice(next(lm._rows(tokens)), 3)
    chance = 10 ** lm._walk(own, lm.Arcs(own, totals, sizes), sums, sizes)
    starts = own.bounds[15:].tolist()
    for k, history in enumerate(histories):
        place = len(history.split())
        mass = sum(chance[starts[4 * k + w] + place] for w in range(4))
        if history in words:  # its end is seen where the history is a probe itself
            mass += chance[starts[words.index(history)] + 1]
        elif history:
            before, last = history.split()
            mass += chance[starts[4 * histories.index(before) + words.index(last)] + 2]
        else:
            mass += 10 ** np.log10((15 + 0.5) / sizes.size)
        assert mass == pytest.approx(1.0, abs=1e-9)


@pytest.mark.parametrize(("slice_bytes", "range_keys"), [(1, 10**9), (700, 50), (1 << 24, 200)])
def test_slices_and_ranges_change_nothing(documents, slice_bytes, range_keys):
    """One slice and many, one hash range and many: the same scores."""
    docs = documents.filter("n_chars < 3000").limit(60)
    key = lambda r: r["doc_id"]
    want = sorted(lm.score(docs, held()).collect(), key=key)
    got = sorted(lm.score(docs, held(), slice_bytes=slice_bytes, range_keys=range_keys).collect(), key=key)
    assert len(got) == 60
    for a, b in zip(got, want):
        assert tuple(a)[:5] == tuple(b)[:5]
        assert a["score"] == pytest.approx(b["score"], rel=1e-9)
        assert a["base_score"] == pytest.approx(b["base_score"], rel=1e-9)


def test_packed_arrays():
    for kind in (np.uint64, np.uint32, np.float64):
        values = np.arange(300).astype(kind) ** 2
        assert (lm.unpack(lm.pack(values), kind) == values).all()
        assert len(lm.unpack(lm.pack(values[:0]), kind)) == 0
    keys = np.unique(np.random.default_rng(1).integers(0, 2**64, 999, dtype=np.uint64, endpoint=False))
    assert (lm.unpack_keys(lm.pack_keys(keys)) == keys).all()


def test_odd_rows(odd_documents, no_documents):
    rows = lm.score(odd_documents, held()).collect()
    assert len(rows) == odd_documents.count()
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    assert lm.score(no_documents, held()).count() == 0
    alone = lm.score(odd_documents, F.lit(True)).collect()  # nothing to learn from
    assert {r["train_tokens"] for r in alone} == {0} and all(r["score"] == 0 for r in alone)


def test_what_is_kept_does_not_depend_on_the_corpus_size(spark):
    """A bigram seen twice counts among more than 400 000 tokens, and what is not common is joined."""
    rows = [(0, "rare pair of words"), (1, "rare pair of words"), (2, "pair of"), (3, "of rare")]
    filler = [(i, " ".join(f"w{(i * 7 + j * j) % 5000}" for j in range(400))) for i in range(10, 1210)]
    frame = spark.createDataFrame(rows + filler, "doc_id long, text string")
    got = {r["doc_id"]: r for r in lm.score(frame, F.col("doc_id") == -1).collect()}
    want = {r[0]: r for r in plain_all(rows + filler)}
    assert got[0]["train_tokens"] > 400_000
    for i in (0, 1, 2, 3, 10, 700):
        assert got[i]["score"] == pytest.approx(want[i][5], rel=1e-9)
    # All of its words after the first but "words" have seen n-grams: far above their own chance.
    assert got[0]["score"] > got[0]["base_score"] + 10


def plain_all(rows):
    """``plain`` with all rows in training: ids whose hash holds out are replaced."""
    free = iter(i for i in range(10**9) if zlib.crc32(str(i).encode()) % 5 != 1)
    names = {next(free): i for i, _ in rows}
    for r in plain([(new, text) for new, (_, text) in zip(names, rows)], 0.0, 0.0):
        yield (names[r[0]], *r[1:])
