from __future__ import annotations

from pyspark.sql import functions as F

from payrisk.functions.rules import RULES, scored
from payrisk.plans import gold
from payrisk.schemas import GOLD_COLUMNS

INPUTS = (
    "tx_by_card_5m int, distinct_merchants_10m int, distinct_countries_1h int, "
    "distinct_cards_per_device int, declined_ratio_1h double, amount double"
)


def test_each_rule_alone_and_all_together(spark):
    edge = (5, 4, 3, 4, 0.45, 1200.0)
    below = (4, 3, 2, 3, 0.4499, 1199.99)
    rows = [tuple(e if i == j else b for j, (e, b) in enumerate(zip(edge, below))) for i in range(6)]
    got = scored(spark.createDataFrame([*rows, edge, below], INPUTS)).collect()
    for row, rule in zip(got, RULES):
        assert (row["risk_score"], row["reasons_text"]) == (rule.weight, rule.reason)
    assert got[6]["risk_score"] == 100
    assert got[6]["reasons_text"] == ", ".join(r.reason for r in RULES)
    assert (got[7]["risk_score"], got[7]["reasons_text"]) == (0, "")


def test_null_inputs_score_nothing(spark):
    row = scored(spark.createDataFrame([(None,) * 6], INPUTS), keep_reasons=True).first()
    assert (row["risk_score"], row["reasons_text"], row["reasons"]) == (0, "", [])


def test_score_facts(spark):
    """Above 10 means that a rule fired; from 20 on, velocity or at least two rules."""
    values = [(a, b, c, d, e, f) for a in (0, 5) for b in (0, 4) for c in (0, 3) for d in (0, 4)
              for e in (0.0, 0.5) for f in (1.0, 2000.0)]
    rows = scored(spark.createDataFrame(values, INPUTS), keep_reasons=True)
    fired = F.size("reasons")
    velocity = F.array_contains("reasons", "high_card_velocity_5m")
    wrong = rows.filter(
        ((F.col("risk_score") > 10) != (fired > 0))
        | ((F.col("risk_score") >= 20) != (velocity | (fired >= 2)))
    )
    assert rows.count() == 64 and wrong.count() == 0


def test_gold_contract(spark, event):
    from payrisk.plans import silver

    table = gold.relations(silver.silver(event({"amount": 5000.0})))
    assert table.columns == GOLD_COLUMNS
    with_list = gold.relations(silver.silver(event({"amount": 5000.0})), keep_reasons=True)
    assert with_list.first()["reasons"] == ["high_amount"]
    assert gold.alerts(silver.silver(event({"amount": 5000.0}))).count() == 0


def test_time_slice_is_half_open(spark):
    rows = spark.sql(
        "SELECT timestamp(c) AS event_time FROM VALUES ('2024-01-01 01:00:00'), "
        "('2024-01-01 02:59:59.999'), ('2024-01-01 03:00:00') AS t(c)"
    )
    assert gold.time_slice(rows, "2024-01-01 01:00:00", "2024-01-01 03:00:00").count() == 2
