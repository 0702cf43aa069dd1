from __future__ import annotations

import random

import pytest

from payrisk.operators.components import connected_components
from payrisk.plans import graph


def _labels(pairs):
    parent: dict[str, str] = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return {x: root(x) for x in parent}


def _check(spark, pairs, **how):
    df = spark.createDataFrame(pairs, "a string, b string")
    rows = connected_components(df, **how).collect()
    assert len(rows) == len({r["node"] for r in rows})
    assert {r["node"]: r["component"] for r in rows} == _labels(pairs)


@pytest.mark.parametrize("seed", [10**6, 1])
def test_random_graph(spark, seed):
    pick = random.Random(seed)
    pairs = [(f"c{pick.randrange(60)}", f"d{pick.randrange(80)}") for _ in range(75)]
    _check(spark, pairs + pairs[:5])


def test_long_chain_and_star(spark):
    chain = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)]
    random.Random(3).shuffle(chain)
    star = [("hub", f"leaf{i}") for i in range(200)]
    _check(spark, chain + star)


def test_no_links(spark):
    empty = spark.createDataFrame([], "a string, b string")
    assert connected_components(empty).count() == 0


SCORED = "payment_id string, customer_id string, card_id string, device_id string, merchant_id string, country string, risk_score int"


def _relations(spark):
    return spark.createDataFrame(
        [
            ("P1", "C1", "K1", "D1", "M1", "ES", 24),
            ("P2", "C1", "K1", "D1", "M1", "FR", 30),
            ("P3", "C2", "K2", "D1", "M2", "ES", 0),
            ("P4", "C2", "K2", "D2", "M2", None, 20),
            ("P5", None, None, "D2", "M2", "ES", 50),
        ],
        SCORED,
    )


def test_nodes_and_edges(spark):
    nodes = {tuple(r) for r in graph.nodes(_relations(spark)).collect()}
    assert len(nodes) == 2 + 2 + 2 + 2 + 5 and ("customer", None) not in nodes
    edges = {(r["type"], r["src"], r["dst"]): r["n_payments"] for r in graph.edges(_relations(spark)).collect()}
    assert edges["CUSTOMER-USES-CARD", "C1", "K1"] == 2
    assert edges["CARD-MADE-PAYMENT", "K2", "P4"] == 1
    assert edges["PAYMENT-ON-DEVICE", "P5", "D2"] == 1
    assert edges["PAYMENT-AT-MERCHANT", "P5", "M2"] == 1
    assert len(edges) == 2 + 4 + 5 + 5


def test_sharing_queries(spark):
    rows = _relations(spark)
    assert [tuple(r) for r in graph.shared_devices(rows).collect()] == [("D1", 2)]
    assert [tuple(r) for r in graph.multi_country_cards(rows).collect()] == [("K1", 2)]
    merchants = {tuple(r) for r in graph.suspicious_merchants(rows).collect()}
    assert merchants == {("M1", 1, 1, 2), ("M2", 1, 1, 2)}
    assert graph.suspicious_merchants(rows, at_least=3).count() == 0


def test_clusters_of_alerts(spark):
    rows = {r["node"]: r["component"] for r in graph.anomaly_components(_relations(spark)).collect()}
    assert rows == {
        "card:K1": "card:K1", "device:D1": "card:K1", "card:K2": "card:K2", "device:D2": "card:K2",
    }
