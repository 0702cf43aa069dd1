"""Table sinks and DDL."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payrisk.functions.values import TIME_FORMAT
from payrisk.sources.csv import CSV_OPTIONS, escaped_lines


#: Between a refreshed table's name and the number of a version.
_VERSION = "__v"


def create_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}")


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table, or a refreshed table's view with all its versions."""
    if _is_view(spark, name):
        spark.sql(f"DROP VIEW {name}")
        for version in versions(spark, name):
            spark.sql(f"DROP TABLE IF EXISTS {version}")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_table(spark: SparkSession, name: str, schema: T.StructType, provider: str = "parquet") -> None:
    """Create an empty table unless it exists. Spark has no primary keys: upserts keep keys unique."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {provider}")


#: Versions of a refreshed table that are kept: the current one and, for readers that have begun, the
#: one before.
VERSIONS = 2


def replace_table(
    df: DataFrame, name: str, provider: str = "parquet", partition_by: Sequence[str] = ()
) -> DataFrame:
    """Full refresh of a table; atomic, and a failed write leaves the old one. Returns its rows.

    Catalogs that can replace a table do so. In the session catalog every refresh writes a new
    version beside the others and then points the view ``name`` to it, which is one change in the
    catalog: readers meet the old rows or the new ones, never none. The rows may come from the
    table itself. Rows are rebalanced on ``partition_by``, so a partition is few files.
    """
    spark = df.sparkSession
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if name.count(".") > 1 and not name.startswith("spark_catalog."):
        writer = df.writeTo(name).using(provider)
        if partition_by:
            writer = writer.partitionedBy(*[F.col(c) for c in partition_by])
        writer.createOrReplace()
        return spark.read.table(name)
    new = f"{name}{_VERSION}{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    try:
        df.write.format(provider).partitionBy(*partition_by).saveAsTable(new)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    if not _is_view(spark, name):  # a table from before there were versions
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {new}")
    for old in versions(spark, name)[:-VERSIONS]:
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    return spark.read.table(name)


def versions(spark: SparkSession, name: str) -> list[str]:
    """The stored versions of a refreshed table, oldest first."""
    namespace, _, table = name.rpartition(".")
    found = spark.sql(f"SHOW TABLES {'IN ' + namespace if namespace else ''} LIKE '{table}{_VERSION}*'")
    prefix = f"{namespace}." if namespace else ""
    return sorted(prefix + r["tableName"] for r in found.toLocalIterator())


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW"


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """A session-catalog table in sorted hash buckets of ``key``. Tables with the same number of
    buckets join on it without moving or sorting rows. One shuffle deals the rows out by bucket, so
    each bucket is one file."""
    spark = df.sparkSession
    drop_table(spark, name)
    dealt = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    dealt.format("parquet").saveAsTable(name)
    return spark.read.table(name)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV part files with header, replacing what was there. ``read_csv`` gives the same values
    back: blanks, empty and missing text, quotes, line breaks (escaped, so files stay splittable)
    and microseconds."""
    escaped_lines(df).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_results(results: dict[str, DataFrame], prefix: str, provider: str = "csv") -> None:
    """One folder per named report below ``prefix``, as CSV with header or as Parquet."""
    for name, df in results.items():
        if provider == "csv":
            write_csv(df, f"{prefix}/{name}")
        else:
            df.write.mode("overwrite").format(provider).save(f"{prefix}/{name}")


def as_messages(df: DataFrame, key: str | None = "payment_id") -> DataFrame:
    """Rows as JSON messages: a ``value`` text and, for the broker's partitioning, a ``key``."""
    value = F.to_json(F.struct("*"), {"timestampFormat": TIME_FORMAT}).alias("value")
    return df.select(value) if key is None else df.select(F.col(key).alias("key"), value)


def publish(df: DataFrame, provider: str = "kafka", **options: str) -> None:
    """Send rows as JSON messages, e.g. with ``topic`` and ``kafka.bootstrap.servers``."""
    as_messages(df).write.format(provider).options(**options).save()


def counted(df: DataFrame, name: str):
    """(df, observation): the row count of a stage, taken while the stage runs, without a job."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
