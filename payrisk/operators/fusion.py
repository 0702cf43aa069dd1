"""Join gold with the feature table and pick suspicious payments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payrisk.functions.rules import risky

# Feature columns that count as 0 when missing, and the home country.
ZERO_WHEN_MISSING = [
    "tx_by_card_5m",
    "distinct_merchants_10m",
    "distinct_countries_1h",
    "declined_ratio_1h",
]
HOME_COUNTRY = "ES"


def fuse(gold: DataFrame, features: DataFrame) -> DataFrame:
    """Inner join on the payment id, both sides already unique by it.

    Only the device type comes from the feature table. ``risk_score`` is gold's own score.
    """
    extra = [c for c in ("payment_id", "device_type") if c in features.columns]
    joined = gold.join(features.select(*extra), "payment_id", "inner")
    score = F.lit(0.0)
    if "puntuacion_riesgo" in joined.columns:
        score = F.coalesce(F.col("puntuacion_riesgo").cast("double"), score)
    return joined.withColumn("risk_score", score).fillna(0, subset=ZERO_WHEN_MISSING)


def suspicious(fused: DataFrame) -> DataFrame:
    """Risky score or declined, several payments within 5 minutes, or not from the home country."""
    frequent = F.col("tx_by_card_5m") > 1
    foreign = ~F.col("country").eqNullSafe(HOME_COUNTRY)
    return fused.filter(risky(F.col("risk_score")) | frequent | foreign)
