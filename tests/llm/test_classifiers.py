"""Held-out accuracy of both classifiers, and their parts."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from payrisk.llm import quality, toxicity
from payrisk.llm.classify import Sample, labelled_sample, logistic, sigmoid
from payrisk.llm.queries import QUERIES

SF_LARGE = "/root/testdata/sf0.1"


def _measured(spark, name, label):
    rows = QUERIES[name](spark, SF_LARGE)
    labels = spark.read.parquet(f"{SF_LARGE}/labels.parquet")
    counts = rows.filter("held_out").join(labels, "doc_id").groupBy(label, "predicted").count()
    return {(r[label], r["predicted"]): r["count"] for r in counts.collect()}, rows


def test_quality_of_held_out_documents(spark):
    n, rows = _measured(spark, "op6_quality_classifier", "quality")
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.98
    assert n[0, 0] / (n[0, 0] + n.get((0, 1), 0)) > 0.95
    assert rows.count() == 10_000 and rows.filter("score not between 0 and 1").count() == 0


def test_toxicity_of_held_out_documents(spark):
    """Some toxic labels of this table follow from nothing in the text."""
    n, rows = _measured(spark, "op2_toxicity", "toxic")
    assert n[0, 0] / (n[0, 0] + n.get((0, 1), 0)) > 0.98
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.6
    assert rows.count() == 10_000 and rows.filter("score not between 0 and 1").count() == 0


def test_labels_of_held_out_rows_are_never_seen(spark):
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(100)] + [(1, 0), (None, 1), (3, None)], "doc_id long, y int"
    )
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    picked = labelled_sample(labels, "y", held, 20)
    assert picked.count() == 20 and picked.filter(held).count() == 0
    # Id 1 has both labels, id 3 keeps the one it has.
    everything = {r["doc_id"]: r["label"] for r in labelled_sample(labels, "y", F.lit(False), 200).collect()}
    assert set(everything) == set(range(100)) - {1} and everything[3] == 1


def test_dual_descent_separates_and_balances_classes():
    pick = np.random.default_rng(0)
    texts = [pick.choice(50, 8, replace=False) for _ in range(400)]
    labels = np.array([int(3 in t or 7 in t) for t in texts])
    ids = np.concatenate([np.sort(t) for t in texts])
    sample = Sample(labels, ids, np.arange(0, 3201, 8))
    model = quality.train(sample)
    scores = model.score(sample.ids, sample.bounds)
    assert ((scores >= 0.5) == (labels > 0)).mean() > 0.97


@pytest.mark.parametrize("labels", [[], [1, 1], [0, 0]])
def test_samples_of_one_class(labels):
    n = len(labels)
    sample = Sample(np.array(labels, dtype=np.int64), np.arange(n), np.arange(n + 1))
    score = quality.train(sample).score(np.arange(3), np.array([0, 3]))[0]
    assert score == 0.5 if not labels else (score > 0.5) == bool(labels[0])
    toxic = toxicity.train(sample)
    assert len(toxic.features) >= len(toxicity.GENERAL) - 2


def test_label_model_finds_accuracies_and_shares_of_correlated_voters():
    pick = np.random.default_rng(1)
    y = pick.random(6000) < 0.2
    rates = [(0.8, 0.02), (0.6, 0.05), (0.7, 0.01), (0.5, 0.3)]
    votes = np.array([np.where(y, pick.random(6000) < a, pick.random(6000) < b) for a, b in rates])
    votes = np.vstack([votes, votes[3]]).T  # the weak voter speaks twice
    start = np.where(votes[:, 0], 0.8, 0.1)
    model = toxicity.fit_label_model(votes, start)
    assert np.allclose(model.speaks[1][:3], [0.8, 0.6, 0.7], atol=0.05)
    assert np.allclose(model.speaks[0][:3], [0.02, 0.05, 0.01], atol=0.03)
    assert abs(model.prior - 0.2) < 0.03
    assert model.shares[3] < 0.6 and model.shares[4] < 0.6 and model.shares[0] > 0.8
    assert ((model.posterior(votes) > 0.5) == y).mean() > 0.95


def test_logistic_reaches_the_optimum():
    pick = np.random.default_rng(2)
    x = pick.normal(size=(500, 3))
    y = sigmoid(x @ [1.0, -2.0, 0.5] + 0.3)
    w = logistic(x, y, 1e-6)
    assert np.allclose(w, [1.0, -2.0, 0.5, 0.3], atol=1e-3)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_rows(spark, module, odd_documents, no_documents):
    labels = spark.createDataFrame(
        [(5, 1, 1), (6, 0, 0), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int"
    )
    model = module.fit(odd_documents, labels, F.lit(None).cast("boolean"))
    out = module.score(odd_documents, model)
    assert out.columns == [c for c in odd_documents.columns if c not in ("text", "score")] + ["score"]
    rows = out.collect()
    assert len(rows) == odd_documents.count() and all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if r["doc_id"] in (1, 2)}
    assert len(empty) == 1
    nothing = module.fit(no_documents, labels.limit(0), F.lit(False))
    assert module.score(no_documents, nothing).count() == 0
    assert module.score(odd_documents, nothing).count() == len(rows)
