"""How many cards a device has been used with."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cards_per_device(rows: DataFrame) -> DataFrame:
    """(device_id, distinct_cards_per_device) over all time; payments without device are one group.

    The pairs are made distinct before they are counted, so a busy device is spread by its cards.
    """
    return (
        rows.groupBy("device_id")
        .agg(F.count_distinct("card_id").cast("int").alias("distinct_cards_per_device"))
    )


def with_cards_per_device(rows: DataFrame, source: DataFrame) -> DataFrame:
    """Add the count, taken over ``source``, to ``rows``: a plain join to one row per device, whose
    busy devices AQE splits."""
    counts = cards_per_device(source).withColumnRenamed("device_id", "key_device")
    match = F.col("device_id").eqNullSafe(F.col("key_device"))
    return rows.join(counts, match, "left").drop("key_device")
