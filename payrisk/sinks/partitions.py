"""Tables on files of which a batch replaces only the partitions that it touches.

A partition is a value of one column: a day, or the hash bucket of a key. A batch finds out which
partitions it touches, reads those alone, and puts their new rows in the place of the old files; all
other files keep name, time and content.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payrisk.session import setting, stage

#: Few bytes can still be many folders to write, so small batches keep several writers.
SMALLEST_TASK = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
_BUCKET = re.compile(r"bucket_of_(\d+)")


def bucket_name(buckets: int) -> str:
    """The partition column says how many buckets its table has, so a table needs no record of it."""
    return f"bucket_of_{buckets}"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a key; a null key has one too."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def is_bucket(column: str) -> bool:
    return _BUCKET.fullmatch(column) is not None


def buckets_of(table: DataFrame) -> int:
    """The number of buckets of a stored table."""
    found = [m for m in map(_BUCKET.fullmatch, table.columns) if m]
    if len(found) != 1:
        raise ValueError(f"no bucketed table: {table.columns}")
    return int(found[0][1])


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder))


def values_in(df: DataFrame, column: str) -> list:
    """The partitions that the rows lie in, ascending: a list of partition values, never of keys."""
    return sorted(r[0] for r in df.select(column).distinct().collect())


def create(rows: DataFrame, path: str, column: str) -> None:
    """Write a new table, partitioned by ``column``. Rows are rebalanced on it: small partitions are
    one file, and AQE splits those that are too large for one task."""
    with setting(rows.sparkSession, SMALLEST_TASK, "64k"):
        rows.hint("rebalance", F.col(column)).write.partitionBy(column).parquet(path)


def read(spark: SparkSession, path: str, column: str | None = None, values: Iterable | None = None) -> DataFrame:
    """A stored table, or only its partitions of the given values: the others are not listed."""
    table = spark.read.parquet(path)
    return table if values is None else table.filter(F.col(column).isin(*values))


def replace(rows: DataFrame, path: str, column: str, touched: Iterable) -> None:
    """Put ``rows`` in the place of the ``touched`` partitions of the table at ``path``.

    The rows may come from that table. They are stored first, so all reading is over when the first
    file is replaced, and a run that is cut off meanwhile can be finished from what is stored.
    Touched partitions without rows are removed.
    """
    spark, touched = rows.sparkSession, list(touched)
    new = stage(rows, "replaced")
    present = set(values_in(new, column))
    if strange := present - set(touched):
        raise ValueError(f"rows of partitions that are not to be replaced: {sorted(strange)[:5]}")
    if present:
        with setting(spark, SMALLEST_TASK, "64k"):
            (
                new.hint("rebalance", F.col(column))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(column)
                .parquet(path)
            )
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    for value in touched:
        if value not in present:
            folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={value}")
            folder.getFileSystem(hadoop).delete(folder, True)
