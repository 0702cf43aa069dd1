"""Time-partitioned exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payrisk.functions.values import TIME_FORMAT, event_instant, time_parts
from payrisk.schemas import with_partitions
from payrisk.session import setting

SMALLEST_TASK = "spark.sql.adaptive.coalescePartitions.minPartitionSize"


def export_by_time(
    df: DataFrame,
    path: str,
    granularity: str,
    provider: str = "json",
    column: str = "event_time",
) -> None:
    """Write ``path/year=…/month=…/…`` down to ``granularity``; rows without readable time are left out.

    Rows are rebalanced on the partition columns: a small partition becomes one file, and AQE splits
    a partition that is too big for one task. Partitions in ``df`` replace their earlier export,
    others stay, so a repeated export leaves no duplicates.
    """
    moment = event_instant(df, column)
    parts = time_parts(moment, granularity)
    rows = df.filter(moment.isNotNull()).withColumns(parts)
    # Few bytes can still be many files to create, so small inputs keep several writers.
    with setting(df.sparkSession, SMALLEST_TASK, "64k"):
        (
            rows.hint("rebalance", *[F.col(p) for p in parts])
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("timestampFormat", TIME_FORMAT)
            .partitionBy(*parts)
            .format(provider)
            .save(path)
        )


def read_export(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    granularity: str,
    provider: str = "json",
) -> DataFrame:
    """Read an export with its partition columns as text; filters on them prune folders."""
    parts = list(time_parts(F.lit(None).cast("timestamp"), granularity))
    reader = spark.read.schema(with_partitions(schema, parts)).format(provider)
    return reader.option("timestampFormat", TIME_FORMAT).load(path)


def partition_counts(df: DataFrame, granularity: str) -> DataFrame:
    """Rows per time partition of an export."""
    parts = list(time_parts(F.lit(None).cast("timestamp"), granularity))
    return df.groupBy(*parts).agg(F.count(F.lit(1)).alias("n_rows"))
