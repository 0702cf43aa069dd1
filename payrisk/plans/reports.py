"""Report and dashboard queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payrisk.functions.rules import ALERT_SCORE, DECLINED, RISKY_SCORE, declined, risky

# Fixed value: length of the high-risk report. The result column names of the three report queries
# are fixed too, as their readers know them.
HIGH_RISK_ROWS = 50
TOP_ROWS = 10


def _alert() -> Column:
    return F.col("risk_score") >= ALERT_SCORE


def high_risk(report: DataFrame, limit: int = HIGH_RISK_ROWS) -> DataFrame:
    """The largest risky payments. Each task keeps its own top rows, so nothing is sorted whole."""
    return (
        report.filter(risky(F.col("puntuacion_riesgo")))
        .select(
            "payment_id", "customer_id", "amount", "puntuacion_riesgo", "country", "event_time"
        )
        .orderBy(F.desc("amount"), F.desc("puntuacion_riesgo"), "payment_id")
        .limit(limit)
    )


def activity(report: DataFrame, by: str = "customer_id") -> DataFrame:
    """Payments, mean amount, declines and top score per customer (or card)."""
    total, top = F.col("total_transacciones"), F.col("max_puntuacion")
    return (
        report.groupBy(by)
        .agg(
            F.count("payment_id").alias("total_transacciones"),
            F.avg("amount").alias("monto_promedio"),
            F.sum(declined()).alias("alertas_confirmadas"),
            F.max("puntuacion_riesgo").alias("max_puntuacion"),
        )
        .filter((total > 1) | (top > RISKY_SCORE))
        .orderBy(F.desc("alertas_confirmadas"), F.desc("total_transacciones"), by)
    )


def geo_patterns(report: DataFrame) -> DataFrame:
    """Volume, amount, mean score and declined percentage per country."""
    volume = F.count("payment_id")
    rate = F.try_divide(F.sum(declined()).cast("double"), volume) * 100
    return (
        report.groupBy("country")
        .agg(
            volume.alias("volumen"),
            F.sum("amount").alias("capital_en_riesgo"),
            F.avg("puntuacion_riesgo").alias("riesgo_medio"),
            F.round(rate, 2).alias("tasa_fraude_pct"),
        )
        .orderBy(F.desc("capital_en_riesgo"), F.desc("tasa_fraude_pct"), "country")
    )


def totals(relations: DataFrame) -> DataFrame:
    """Number of payments and of alerts."""
    return relations.agg(
        F.count(F.lit(1)).alias("transactions"), F.count_if(_alert()).alias("alerts")
    )


def timeline(relations: DataFrame, width: str = "1 hour") -> DataFrame:
    """Payments, alerts and declines per time bucket."""
    return (
        relations.groupBy(F.window("event_time", width).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("transactions"),
            F.count_if(_alert()).alias("alerts"),
            F.count_if(F.col("status") == DECLINED).alias("declined"),
        )
        .select(F.col("w.start").alias("bucket_start"), "transactions", "alerts", "declined")
        .orderBy("bucket_start")
    )


def top_risk(relations: DataFrame, by: str, limit: int = TOP_ROWS) -> DataFrame:
    """Merchants or cards with the most alerts, then the highest mean score."""
    return (
        relations.groupBy(by)
        .agg(
            F.count_if(_alert()).alias("alerts"),
            F.avg("risk_score").alias("mean_score"),
            F.max("risk_score").alias("max_score"),
            F.count(F.lit(1)).alias("transactions"),
        )
        .orderBy(F.desc("alerts"), F.desc("mean_score"), by)
        .limit(limit)
    )
