"""Graph tables and graph queries over gold relations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payrisk.functions.rules import ALERT_SCORE
from payrisk.operators.components import connected_components

# Node kinds with their id column, and edge types from source to destination.
NODE_KINDS = {
    "customer": "customer_id",
    "card": "card_id",
    "device": "device_id",
    "merchant": "merchant_id",
    "payment": "payment_id",
}
EDGE_TYPES = {
    "CUSTOMER-USES-CARD": ("customer", "card"),
    "CARD-MADE-PAYMENT": ("card", "payment"),
    "PAYMENT-ON-DEVICE": ("payment", "device"),
    "PAYMENT-AT-MERCHANT": ("payment", "merchant"),
}


def nodes(relations: DataFrame) -> DataFrame:
    """(kind, id), each entity once.

    Relations hold each payment once, so payments are only projected; the other kinds repeat, and
    map-side aggregation shrinks them to a few rows before their shuffle.
    """
    repeating = [
        F.struct(F.lit(kind).alias("kind"), F.col(column).alias("id"))
        for kind, column in NODE_KINDS.items()
        if kind != "payment"
    ]
    entities = (
        relations.select(F.explode(F.array(*repeating)).alias("n"))
        .select("n.kind", "n.id")
        .filter(F.col("id").isNotNull())
        .distinct()
    )
    payments = relations.select(F.lit("payment").alias("kind"), F.col("payment_id").alias("id"))
    return entities.unionByName(payments)


def edges(relations: DataFrame) -> DataFrame:
    """(type, src, dst, n_payments): each related pair once, with the payments behind it.

    An edge at a payment stands for that one payment, so only customer-card pairs are grouped.
    """

    def ends(name: str) -> list:
        src, dst = EDGE_TYPES[name]
        return [
            F.lit(name).alias("type"),
            F.col(NODE_KINDS[src]).alias("src"),
            F.col(NODE_KINDS[dst]).alias("dst"),
        ]

    single = [name for name, kinds in EDGE_TYPES.items() if "payment" in kinds]
    repeating = [name for name in EDGE_TYPES if name not in single]
    per_payment = (
        relations.select(F.explode(F.array(*[F.struct(*ends(n)) for n in single])).alias("e"))
        .select("e.type", "e.src", "e.dst", F.lit(1).cast("long").alias("n_payments"))
        .filter("src IS NOT NULL AND dst IS NOT NULL")
    )
    grouped = (
        relations.select(F.explode(F.array(*[F.struct(*ends(n)) for n in repeating])).alias("e"))
        .select("e.type", "e.src", "e.dst")
        .filter("src IS NOT NULL AND dst IS NOT NULL")
        .groupBy("type", "src", "dst")
        .agg(F.count(F.lit(1)).alias("n_payments"))
    )
    return per_payment.unionByName(grouped)


def shared_devices(relations: DataFrame, at_least: int = 2) -> DataFrame:
    """Devices used with several cards."""
    return (
        relations.filter(F.col("device_id").isNotNull())
        .groupBy("device_id")
        .agg(F.count_distinct("card_id").alias("n_cards"))
        .filter(F.col("n_cards") >= at_least)
    )


def multi_country_cards(relations: DataFrame, at_least: int = 2) -> DataFrame:
    """Cards used in several countries."""
    return (
        relations.filter(F.col("card_id").isNotNull())
        .groupBy("card_id")
        .agg(F.count_distinct("country").alias("n_countries"))
        .filter(F.col("n_countries") >= at_least)
    )


def suspicious_merchants(relations: DataFrame, at_least: int = 2) -> DataFrame:
    """Merchants linked to several cards and devices that have an alert."""
    return (
        relations.filter((F.col("risk_score") >= ALERT_SCORE) & F.col("merchant_id").isNotNull())
        .groupBy("merchant_id")
        .agg(
            F.count_distinct("card_id").alias("n_cards"),
            F.count_distinct("device_id").alias("n_devices"),
        )
        .withColumn("n_entities", F.col("n_cards") + F.col("n_devices"))
        .filter(F.col("n_entities") >= at_least)
    )


def alert_links(relations: DataFrame) -> DataFrame:
    """(a, b): card and device of each alert, once."""
    return (
        relations.filter(F.col("risk_score") >= ALERT_SCORE)
        .select(
            F.concat(F.lit("card:"), "card_id").alias("a"),
            F.concat(F.lit("device:"), "device_id").alias("b"),
        )
        .filter("a IS NOT NULL AND b IS NOT NULL")
        .distinct()
    )


def anomaly_components(relations: DataFrame) -> DataFrame:
    """(node, component): clusters of cards and devices that share alerts."""
    return connected_components(alert_links(relations))
