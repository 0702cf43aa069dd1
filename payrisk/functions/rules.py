"""Fraud rules: one table that yields both the reasons and the score."""

from __future__ import annotations

from functools import reduce
from operator import add
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Rule(NamedTuple):
    reason: str
    column: str
    at_least: float
    weight: int


# Reason, input column, threshold (inclusive) and weight; the order is the order
# in which reasons are listed.
RULES = [
    Rule("high_card_velocity_5m", "tx_by_card_5m", 5, 24),
    Rule("many_merchants_10m", "distinct_merchants_10m", 4, 18),
    Rule("many_countries_1h", "distinct_countries_1h", 3, 18),
    Rule("device_shared_by_cards", "distinct_cards_per_device", 4, 16),
    Rule("high_declined_ratio_1h", "declined_ratio_1h", 0.45, 12),
    Rule("high_amount", "amount", 1200, 12),
]
# The score from which a payment is an alert, and above which it is labelled risky.
ALERT_SCORE = 20
RISKY_SCORE = 10
DECLINED = "declined"


def _fires(rule: Rule) -> Column:
    return F.col(rule.column) >= rule.at_least


def reasons() -> Column:
    """Names of the rules that fire, in table order; a null input never fires."""
    return F.array_compact(F.array(*[F.when(_fires(r), F.lit(r.reason)) for r in RULES]))


def risk_score() -> Column:
    """Sum of the weights of the rules that fire."""
    return reduce(add, [F.when(_fires(r), F.lit(r.weight)).otherwise(F.lit(0)) for r in RULES])


def scored(silver: DataFrame, keep_reasons: bool = False) -> DataFrame:
    """Add ``risk_score`` and ``reasons_text``, and the ``reasons`` array on request."""
    names = reasons()
    columns = [risk_score().alias("risk_score"), F.concat_ws(", ", names).alias("reasons_text")]
    if keep_reasons:
        columns.insert(0, names.alias("reasons"))
    return silver.select("*", *columns)


def declined() -> Column:
    """1 for a declined payment, else 0; an unknown status counts as not declined."""
    return F.when(F.col("status") == DECLINED, F.lit(1)).otherwise(F.lit(0))


def risky(score: Column) -> Column:
    """Declined or scored above the risk threshold; unknown status and score count as no."""
    return F.coalesce(F.col("status") == DECLINED, F.lit(False)) | F.coalesce(
        score > RISKY_SCORE, F.lit(False)
    )
