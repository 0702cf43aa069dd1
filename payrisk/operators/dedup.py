"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The first row of each key under ``order_by``; remaining ties are broken by all columns.

    A total order makes the survivor independent of partitioning, so a plan may recompute this.
    Spark turns ``row_number() = 1`` into a group limit on both sides of the shuffle: each map task
    passes on one row per key, so a key with any number of copies cannot flood a reducer.
    """
    rest = [c for c in df.columns if c not in {*keys, *order_by}]
    ranked = Window.partitionBy(*keys).orderBy(*order_by, *rest)
    return (
        df.withColumn("copy_no", F.row_number().over(ranked))
        .filter(F.col("copy_no") == 1)
        .drop("copy_no")
    )
