"""Normalize and clean records from mixed sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payrisk.functions.values import country_code, event_instant, number_or_null, stripped
from payrisk.operators.dedup import first_per_key

# Feature-table names and the names they have in gold.
FEATURE_NAMES = {"transaction_id": "payment_id", "user_id": "customer_id"}


def normalize(df: DataFrame) -> DataFrame:
    """Apply each field's rule where the field exists; nulls stay null. One projection."""
    scores_are_text = dict(df.dtypes).get("puntuacion_riesgo") == "string"
    rules = {
        "payment_id": stripped,
        "card_id": lambda c: F.upper(stripped(c)),
        "amount": number_or_null,
        "event_time": lambda _: event_instant(df, "event_time"),
        "country": country_code,
        "status": lambda c: F.lower(stripped(c)),
        "puntuacion_riesgo": number_or_null if scores_are_text else lambda c: c,
    }
    return df.select(
        *[rules[c](F.col(c)).alias(c) if c in rules else F.col(c) for c in df.columns]
    )


def clean_payments(
    df: DataFrame, read_order: Sequence[str] = ("event_time",), unique: bool = False
) -> DataFrame:
    """Normalized payments, the first of each id in ``read_order``, with a card and an amount > 0.

    Duplicates go first, so an unusable first copy hides a usable later one. ``unique`` declares
    that normalized ids do not repeat, as in tables made here; that saves a shuffle.
    """
    rows = normalize(df)
    first = rows if unique else first_per_key(rows, ["payment_id"], read_order)
    return first.filter(F.col("card_id").isNotNull() & (F.col("amount") > 0))


def clean_features(
    df: DataFrame, read_order: Sequence[str] = ("event_time",), unique: bool = False
) -> DataFrame:
    """Feature rows under gold's column names, normalized, one per payment (see above)."""
    rows = normalize(df.withColumnsRenamed(FEATURE_NAMES))
    return rows if unique else first_per_key(rows, ["payment_id"], read_order)
