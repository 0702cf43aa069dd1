"""Bronze to silver: type, deduplicate, add behavioural features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payrisk.functions.values import event_instant
from payrisk.operators.card_windows import CARD_FEATURES, card_features
from payrisk.operators.dedup import first_per_key
from payrisk.operators.device_sharing import with_cards_per_device
from payrisk.schemas import EVENT_COLUMNS, SILVER_COLUMNS
from payrisk.session import stage


def typed(bronze: DataFrame) -> DataFrame:
    """Rows with a readable event time and a payment id, the time as a timestamp."""
    return (
        bronze.select(*EVENT_COLUMNS)
        .withColumn("event_time", event_instant(bronze, "event_time"))
        .filter(F.col("event_time").isNotNull() & F.col("payment_id").isNotNull())
    )


def deduplicated(bronze: DataFrame) -> DataFrame:
    """One typed row per payment id, the earliest."""
    return first_per_key(typed(bronze), ["payment_id"], ["event_time"])


def stored(bronze: DataFrame) -> DataFrame:
    """The deduplicated rows as a stored table: features read them several times."""
    return stage(deduplicated(bronze), "deduplicated")


def card_behaviour(bronze: DataFrame, wanted: Sequence[str] = tuple(CARD_FEATURES)) -> DataFrame:
    """Deduplicated payments with card features only; the work is that of the ``wanted`` ones."""
    return card_features(stored(bronze), wanted)


def silver(bronze: DataFrame) -> DataFrame:
    """The silver table: 12 event columns and 5 features. One way for every size of table and key."""
    rows = stored(bronze)
    return with_cards_per_device(card_features(rows), rows).select(*SILVER_COLUMNS)
