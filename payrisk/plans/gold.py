"""Silver to gold: relations (every payment, scored) and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payrisk.functions.rules import ALERT_SCORE, risk_score, scored
from payrisk.schemas import GOLD_COLUMNS


def relations(silver: DataFrame, keep_reasons: bool = False) -> DataFrame:
    """Every payment with score and reasons text (and the reasons array on request)."""
    names = GOLD_COLUMNS + (["reasons"] if keep_reasons else [])
    return scored(silver, keep_reasons).select(*names)


def alerts(silver: DataFrame, keep_reasons: bool = False) -> DataFrame:
    """The payments whose score reaches the alert threshold."""
    return relations(silver, keep_reasons).filter(F.col("risk_score") >= ALERT_SCORE)


def score_or_recomputed(score: Column) -> Column:
    """A missing score is computed again from the features."""
    return F.coalesce(score, risk_score())


def score_or_zero(score: Column) -> Column:
    """A missing score counts as 0."""
    return F.coalesce(score, F.lit(0))


#: Partition column of stored relations: the day of the event time.
EVENT_DAY = "event_day"


def with_day(df: DataFrame, column: str = "event_time") -> DataFrame:
    """``df`` with the column that stored relations are partitioned by."""
    return df.withColumn(EVENT_DAY, F.to_date(column))


def time_slice(df: DataFrame, start: str, end: str, column: str = "event_time") -> DataFrame:
    """Rows with start <= time < end. The bounds are literals, so they reach the scan; of a table
    that is partitioned by day only the days from start to end are listed."""
    moment = F.col(column)
    low, high = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    rows = df.filter((moment >= low) & (moment < high))
    if EVENT_DAY in df.columns:
        rows = rows.filter(F.col(EVENT_DAY).between(F.to_date(low), F.to_date(high)))
    return rows
