"""Stored aggregates that increments add to, so that old rows are not read again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payrisk.session import stage
from payrisk.sinks import partitions

BUCKETS = 64


def add(
    spark: SparkSession,
    path: str,
    delta: DataFrame,
    keys: Sequence[str],
    value: str,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Add ``delta`` (keys, value; may be negative) to the sums stored at ``path``.

    The table lies in hash buckets of its keys; only those that the delta's keys fall into are read
    and replaced. Keys whose sum reaches zero leave it. Returns (keys, before, after) of every key
    of the delta. Null is a key like any other.
    """
    if partitions.exists(spark, path):
        buckets = partitions.buckets_of(partitions.read(spark, path))
    name = partitions.bucket_name(buckets)
    change = stage(
        delta.groupBy(*keys)
        .agg(F.sum(value).cast("long").alias(value))
        .filter(F.col(value) != 0)
        .withColumn(name, partitions.bucket_of(keys, buckets)),
        "delta",
    )
    new = change.withColumns({"before": F.lit(0).cast("long"), "touched": F.lit(True)})
    if not partitions.exists(spark, path):
        both, touched = new, None
    else:
        touched = partitions.values_in(change, name)
        old = (
            partitions.read(spark, path, name, touched)
            .select(*keys, value, name)
            .withColumns({"before": F.col(value), "touched": F.lit(False)})
        )
        both = old.unionByName(new)
    merged = stage(
        both.groupBy(name, *keys).agg(
            F.sum(value).alias("after"),
            F.sum("before").alias("before"),
            F.max("touched").alias("touched"),
        ),
        "sums",
    )
    left = merged.filter("after != 0").select(*keys, F.col("after").alias(value), name)
    if touched is None:
        if not left.isEmpty():
            partitions.create(left, path, name)
    elif touched:
        partitions.replace(left, path, name, touched)
    return merged.filter("touched").select(*keys, "before", "after")


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(keys, value) of a stored aggregate, as ``schema`` declares them; nothing was added: no rows."""
    if not partitions.exists(spark, path):
        return spark.createDataFrame([], schema)
    table = partitions.read(spark, path)
    return table.drop(partitions.bucket_name(partitions.buckets_of(table)))
