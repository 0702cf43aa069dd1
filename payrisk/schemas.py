"""Declared schemas and column orders of every table."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names, order and types of the tables other systems read.
EVENT = T.StructType(
    [
        T.StructField("event_time", T.StringType()),
        T.StructField("payment_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("card_id", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("ip", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("mcc", T.StringType()),
    ]
)
EVENT_COLUMNS = EVENT.names
CORRUPT = "_corrupt_record"

FEATURE_COLUMNS = [
    "tx_by_card_5m",
    "distinct_merchants_10m",
    "distinct_countries_1h",
    "distinct_cards_per_device",
    "declined_ratio_1h",
]
SILVER_COLUMNS = EVENT_COLUMNS + FEATURE_COLUMNS
GOLD_COLUMNS = SILVER_COLUMNS + ["risk_score", "reasons_text"]

FEATURE_TABLE = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("is_fraud", T.IntegerType()),
        T.StructField("risk_score", T.DoubleType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("country", T.StringType()),
        T.StructField("device_type", T.StringType()),
        T.StructField("ingestion_time", T.TimestampType()),
    ]
)

REPORT = T.StructType(
    [
        T.StructField("payment_id", T.StringType()),
        T.StructField("event_time", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("card_id", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("mcc", T.StringType()),
        T.StructField("tx_by_card_5m", T.IntegerType()),
        T.StructField("distinct_merchants_10m", T.IntegerType()),
        T.StructField("distinct_countries_1h", T.IntegerType()),
        T.StructField("distinct_cards_per_device", T.IntegerType()),
        T.StructField("declined_ratio_1h", T.DoubleType()),
        T.StructField("puntuacion_riesgo", T.IntegerType()),
        T.StructField("reasons", T.StringType()),
        T.StructField("reasons_text", T.StringType()),
        T.StructField("device_type", T.StringType()),
        T.StructField("risk_score", T.DoubleType()),
    ]
)

def with_partitions(schema: T.StructType, names: list[str]) -> T.StructType:
    """``schema`` plus text partition columns, so that month=03 is read as '03' and not as 3."""
    return T.StructType(schema.fields + [T.StructField(n, T.StringType()) for n in names])
