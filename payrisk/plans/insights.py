"""Gold and feature table to the insights report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payrisk.operators.cleaning import clean_features, clean_payments
from payrisk.operators.fusion import fuse, suspicious
from payrisk.schemas import REPORT
from payrisk.sinks.tables import save_bucketed


def with_native_score(gold: DataFrame) -> DataFrame:
    """Gold with its score also under the name the cleaning and the reports use."""
    return gold.withColumn("puntuacion_riesgo", F.col("risk_score"))


def fused_payments(gold: DataFrame, features: DataFrame, unique: bool = True) -> DataFrame:
    """Cleaned gold joined with the cleaned feature table.

    Both are tables with unique ids if they were made here; ``unique`` false removes repeats first.
    """
    return fuse(
        clean_payments(with_native_score(gold), unique=unique),
        clean_features(features, unique=unique),
    )


def store_sides(
    gold: DataFrame, features: DataFrame, names: tuple[str, str], buckets: int, unique: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Both cleaned sides of the fusion as tables in the same buckets of the payment id. Reports
    that fuse them later move no row."""
    return (
        save_bucketed(clean_payments(with_native_score(gold), unique=unique), names[0], "payment_id", buckets),
        save_bucketed(clean_features(features, unique=unique), names[1], "payment_id", buckets),
    )


def as_report(rows: DataFrame) -> DataFrame:
    """The 21 report columns in their declared order and types; absent ones are null."""
    time_text = F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    columns = []
    for field in REPORT.fields:
        if field.name == "event_time":
            value = time_text
        elif field.name == "reasons" and dict(rows.dtypes).get("reasons") == "array<string>":
            value = F.concat_ws(", ", "reasons")
        elif field.name in rows.columns:
            value = F.col(field.name)
        else:
            value = F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    return rows.select(*columns)


def insights_report(gold: DataFrame, features: DataFrame, unique: bool = True) -> DataFrame:
    """Suspicious payments of the fused set in report shape."""
    return as_report(suspicious(fused_payments(gold, features, unique)))
