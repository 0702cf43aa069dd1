"""Dashboards from stored partial aggregates instead of from all payments.

A partial is one row per hour and merchant, card, customer or everything together, with state that
merges: counts, sums and maxima. The rows of a day are a partition, so an increment replaces those of
the days whose payments it changed and the rest stays. Totals, timeline, top lists and activity come
from partials alone.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payrisk.functions.rules import ALERT_SCORE, DECLINED, RISKY_SCORE, RULES, declined
from payrisk.plans import gold, silver_store
from payrisk.plans.reports import TOP_ROWS
from payrisk.sinks import partitions

DAY = silver_store.DAY
# Entities of a dashboard and the column that names them; "all" is the one row for everything.
KINDS = {"all": None, "merchant": "merchant_id", "card": "card_id", "customer": "customer_id"}


def partials(rows: DataFrame, score: str = "risk_score") -> DataFrame:
    """Partial aggregates of scored payments: (day, hour, kind, id) and mergeable state.

    Payments are combined before the shuffle, so a busy merchant travels as its hours."""
    nobody = F.lit(None).cast("string")
    entities = [
        F.struct(F.lit(kind).alias("kind"), (F.col(column) if column else nobody).alias("id"))
        for kind, column in KINDS.items()
    ]
    points = F.col(score)
    narrow = rows.select(
        silver_store.day_of(F.unix_seconds("event_time")).alias(DAY),
        F.date_trunc("hour", "event_time").alias("hour"),
        F.explode(F.array(*entities)).alias("e"),
        points.alias("score"),
        "payment_id",
        "amount",
        "status",
    )
    return narrow.groupBy(DAY, "hour", F.col("e.kind").alias("kind"), F.col("e.id").alias("id")).agg(
        F.count(F.lit(1)).alias("transactions"),
        F.count("payment_id").alias("payments"),
        F.count_if(F.col("score") >= ALERT_SCORE).alias("alerts"),
        F.count_if(F.col("status") == DECLINED).alias("declined"),
        F.sum(declined()).alias("declined_flags"),
        F.count("score").alias("scores"),
        F.sum("score").alias("score_sum"),
        F.max("score").alias("score_max"),
        F.count("amount").alias("amounts"),
        F.sum("amount").alias("amount_sum"),
    )


def refresh(spark: SparkSession, path: str, rows: DataFrame, days: Iterable[int]) -> None:
    """Replace the partials of some days by those of ``rows``, all payments of these days."""
    days = list(days)
    if not partitions.exists(spark, path):
        partitions.create(partials(rows), path, DAY)
    elif days:
        partitions.replace(partials(rows), path, DAY, days)


def follow(spark: SparkSession, path: str, root: str, change: silver_store.Change) -> list[int]:
    """Bring the partials of a silver store up to date after an increment; returns the days replaced.

    Scores change on the days that the increment replaced, and where a device has gone over the
    rule's number of cards, on each of the device's days. Of these the payments are scored again.
    """
    days = sorted({*change.days, *_device_days(spark, root, change.devices)})
    if days:
        relations = gold.relations(silver_store.silver(spark, root, days))
        refresh(spark, path, relations, days)
    return days


def _device_days(spark: SparkSession, root: str, devices: DataFrame) -> list[int]:
    """Days with payments of devices whose rule fires now and did not, or the other way round. Two
    columns of the payments are read, and only if there are such devices."""
    (least,) = (r.at_least for r in RULES if r.column == silver_store.COUNT)
    crossed = devices.filter((F.col("before") >= least) != (F.col("after") >= least))
    if crossed.isEmpty():
        return []
    payments = silver_store.rows(spark, root).select("device_id", DAY)
    names = crossed.select(F.col("device_id").alias("name"))
    match = payments["device_id"].eqNullSafe(names["name"])
    return partitions.values_in(payments.join(names, match, "left_semi"), DAY)


def read(spark: SparkSession, path: str) -> DataFrame:
    return partitions.read(spark, path)


def _of(stored: DataFrame, kind: str) -> DataFrame:
    return stored.filter(F.col("kind") == kind)


def _mean(total: str, n: str) -> Column:
    return F.try_divide(F.sum(total).cast("double"), F.sum(n))


def totals(stored: DataFrame) -> DataFrame:
    """Number of payments and of alerts."""
    return _of(stored, "all").agg(
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("transactions", "alerts"))
    )


def timeline(stored: DataFrame, width: str = "1 hour") -> DataFrame:
    """Payments, alerts and declines per time bucket of whole hours."""
    return (
        _of(stored, "all")
        .groupBy(F.window("hour", width).alias("w"))
        .agg(*(F.sum(c).alias(c) for c in ("transactions", "alerts", "declined")))
        .select(F.col("w.start").alias("bucket_start"), "transactions", "alerts", "declined")
        .orderBy("bucket_start")
    )


def top_risk(stored: DataFrame, kind: str, limit: int = TOP_ROWS) -> DataFrame:
    """Merchants or cards with the most alerts, then the highest mean score."""
    column = KINDS[kind]
    return (
        _of(stored, kind)
        .groupBy(F.col("id").alias(column))
        .agg(
            F.sum("alerts").alias("alerts"),
            _mean("score_sum", "scores").alias("mean_score"),
            F.max("score_max").alias("max_score"),
            F.sum("transactions").alias("transactions"),
        )
        .orderBy(F.desc("alerts"), F.desc("mean_score"), column)
        .limit(limit)
    )


def activity(stored: DataFrame, kind: str = "customer") -> DataFrame:
    """Payments, mean amount, declines and top score per customer or card."""
    column = KINDS[kind]
    total, top = F.col("total_transacciones"), F.col("max_puntuacion")
    return (
        _of(stored, kind)
        .groupBy(F.col("id").alias(column))
        .agg(
            F.sum("payments").alias("total_transacciones"),
            _mean("amount_sum", "amounts").alias("monto_promedio"),
            F.sum("declined_flags").alias("alertas_confirmadas"),
            F.max("score_max").alias("max_puntuacion"),
        )
        .filter((total > 1) | (top > RISKY_SCORE))
        .orderBy(F.desc("alertas_confirmadas"), F.desc("total_transacciones"), column)
    )
