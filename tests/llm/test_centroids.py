"""Clusters against plain rounds in Python integers."""

from __future__ import annotations

import hashlib
import math
import random

import pytest

from payrisk.llm import centroids
from payrisk.session import setting


def plain(rows, k=8, rounds=10, dim=64):
    kept = []
    for vec_id, vector in rows:
        if vector is None or len(vector) != dim:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, [math.floor(1024 * x) for x in vector]))
    if not kept:
        return {}
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    means = [v for _, v in order[:k]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, m)) for m in means]
            out.append((min(d), d.index(min(d))))
        return out

    for _ in range(rounds):
        chosen = assign()
        for c in range(len(means)):
            own = [v for (_, v), (_, x) in zip(kept, chosen) if x == c]
            if own:
                means[c] = [sum(col) // len(own) for col in zip(*own)]
    chosen = assign()
    each = [sum(d for d, x in chosen if x == c) for c in range(len(means))]
    return sorted(
        (i, c, d, each[c], sum(each), ",".join(map(str, means[c]))) for (i, _), (d, c) in zip(kept, chosen)
    )


def found(frame, **how):
    return sorted(
        (r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], ",".join(map(str, r["centroid"])))
        for r in centroids.cluster(frame, **how).collect()
    )


def test_query_equals_plain(spark, run_query):
    from tests.conftest import SF

    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = [(*x[:5], hashlib.sha256(x[5].encode()).hexdigest()) for x in plain(rows)]
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(tuple(r[c] for c in columns) for r in run_query(12).collect()) == want


@pytest.mark.parametrize("batch", [7, 10_000])
def test_any_slices_give_the_same(spark, batch, monkeypatch):
    """Ties, copies, a hot vector and clusters that run empty, over many small slices."""
    pick = random.Random(3)
    rows = [(i, [float(pick.randrange(-3, 4)) / 1024 for _ in range(4)]) for i in range(200)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(200, 300)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(batch)):
        assert found(frame, dim=4, rounds=4) == plain(rows, rounds=4, dim=4)


def test_odd_rows(spark):
    """Null, short, long and non-finite vectors take no part; few vectors are few clusters; a
    clashing column does no harm; a component beyond any long's reach counts as the largest."""
    inf, nan = math.inf, math.nan
    rows = [
        (1, [1.0, 2.0]), (2, None), (3, []), (4, [1.0]), (5, [1.0, 2.0, 3.0]), (6, [1.0, None]),
        (7, [nan, 1.0]), (8, [1.0, -inf]), (1, [1.0, 2.0]), (9, [-1e-9, 0.25]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr(
        "*", "1 as cluster", "'x' as v", "2 as centroid"
    )
    assert found(frame, dim=2) == plain(rows, dim=2)
    assert centroids.cluster(frame.limit(0), dim=2).count() == 0
    large = spark.createDataFrame(
        [(1, [1e300, 0.0]), (2, [-1e300, 0.0]), (None, [1.0, 1.0])], "vec_id long, embedding array<double>"
    )
    assert sorted(str(r["vec_id"]) for r in centroids.cluster(large, dim=2).collect()) == ["1", "2", "None"]
