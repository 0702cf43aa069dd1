"""Keyed upsert: insert new keys, update chosen columns of known ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payrisk.session import stage
from payrisk.sinks import partitions

# Key and updated columns of the feature table.
FEATURE_KEY = "transaction_id"
FEATURE_UPDATES = ["amount", "country"]

#: Buckets of a new bucketed table; about its bytes / 512 MB.
BUCKETS = 64


def as_one_batch(
    source: DataFrame,
    key: str = FEATURE_KEY,
    update_columns: Sequence[str] = tuple(FEATURE_UPDATES),
    order_by: str = "event_time",
) -> DataFrame:
    """One row per key with the effect of upserting the rows one by one in ``order_by`` order;
    ties are broken by all columns.

    The first row of a key inserts it; later ones change its update columns only. Both picks are
    aggregates that combine before the shuffle, so a key with many rows stays cheap.
    """
    updates = F.struct(*update_columns)
    inserted = F.struct(*[c for c in source.columns if c not in {key, *update_columns}])
    order = F.struct(order_by, *[c for c in source.columns if c not in (key, order_by)])
    picked = source.groupBy(key).agg(
        F.min_by(inserted, order).alias("first"), F.max_by(updates, order).alias("last")
    )
    return picked.select(key, "first.*", "last.*").select(*source.columns)


def upserted(
    target: DataFrame,
    source: DataFrame,
    key: str = FEATURE_KEY,
    update_columns: Sequence[str] = tuple(FEATURE_UPDATES),
) -> DataFrame:
    """The target after the upsert of ``source``; both must have unique keys.

    For tables without MERGE: one full outer join, each row of either side shuffled once. Whether a
    side matched is decided by its presence, not by nulls, so an update may set a column to null.
    """
    unknown = {key, *update_columns} - set(target.columns)
    if unknown or target.columns != source.columns:
        raise ValueError(f"columns of target and source must agree and hold {sorted(unknown)}")
    old = target.select(F.col(key).alias("old_key"), F.struct(*target.columns).alias("old"))
    new = source.select(F.col(key).alias("new_key"), F.struct(*source.columns).alias("new"))
    joined = old.join(new, F.col("old_key") == F.col("new_key"), "full_outer")
    in_old, in_new = F.col("old_key").isNotNull(), F.col("new_key").isNotNull()

    def pick(name: str):
        from_new = in_new if name in update_columns else ~in_old
        return F.when(from_new, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name)

    return joined.select(*[pick(c) for c in target.columns])


def write_upsert(
    spark: SparkSession, target_path: str, source: DataFrame, new_path: str, **how
) -> DataFrame:
    """Upsert into a Parquet table: the result goes to ``new_path``; readers then switch to it."""
    result = upserted(spark.read.parquet(target_path), source, **how)
    result.write.parquet(new_path)
    return spark.read.schema(result.schema).parquet(new_path)


def create_buckets(rows: DataFrame, path: str, key: str = FEATURE_KEY, buckets: int = BUCKETS) -> None:
    """Write a table for ``upsert_buckets``: a partition per hash bucket of the key."""
    name = partitions.bucket_name(buckets)
    partitions.create(rows.withColumn(name, partitions.bucket_of([key], buckets)), path, name)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a bucketed table, without its partition column."""
    table = partitions.read(spark, path)
    return table.drop(partitions.bucket_name(partitions.buckets_of(table)))


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """A feature table on Parquet, in buckets or not."""
    table = spark.read.parquet(path)
    return table.select(*[c for c in table.columns if not partitions.is_bucket(c)])


def upsert_buckets(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    key: str = FEATURE_KEY,
    update_columns: Sequence[str] = tuple(FEATURE_UPDATES),
) -> list[int]:
    """Upsert ``source`` (unique keys) in place into a bucketed table; returns the buckets touched.

    Only the buckets that the batch's keys fall into are read, joined and replaced. The batch is
    stored first: its buckets are a short list, and it is read again by the join.
    """
    table = partitions.read(spark, path)
    buckets = partitions.buckets_of(table)
    name = partitions.bucket_name(buckets)
    batch = stage(source.withColumn(name, partitions.bucket_of([key], buckets)), "batch")
    touched = partitions.values_in(batch, name)
    if not touched:
        return []
    target = touched_rows(spark, path, touched).select(*source.columns)
    result = upserted(target, batch.drop(name), key, update_columns)
    result = result.withColumn(name, partitions.bucket_of([key], buckets))
    partitions.replace(result, path, name, touched)
    return touched


def touched_rows(spark: SparkSession, path: str, touched: Sequence[int]) -> DataFrame:
    """The rows of some buckets of a table; the scan lists and reads no others."""
    name = partitions.bucket_name(partitions.buckets_of(partitions.read(spark, path)))
    return partitions.read(spark, path, name, touched)


def merge_statement(
    target: str,
    source: str,
    columns: Sequence[str],
    key: str = FEATURE_KEY,
    update_columns: Sequence[str] = tuple(FEATURE_UPDATES),
) -> str:
    """The upsert as MERGE INTO, for catalogs whose tables support it."""
    updates = ", ".join(f"t.{c} = s.{c}" for c in update_columns)
    return (
        f"MERGE INTO {target} t USING {source} s ON t.{key} = s.{key} "
        f"WHEN MATCHED THEN UPDATE SET {updates} "
        f"WHEN NOT MATCHED THEN INSERT ({', '.join(columns)}) "
        f"VALUES ({', '.join('s.' + c for c in columns)})"
    )


def mysql_upsert_statement(
    target: str,
    staging: str,
    columns: Sequence[str],
    update_columns: Sequence[str] = tuple(FEATURE_UPDATES),
) -> str:
    """The statement a MySQL database runs once the executors have filled ``staging`` over JDBC."""
    names = ", ".join(columns)
    updates = ", ".join(f"{c} = VALUES({c})" for c in update_columns)
    return (
        f"INSERT INTO {target} ({names}) SELECT {names} FROM {staging} "
        f"ON DUPLICATE KEY UPDATE {updates}"
    )


def write_jdbc_staging(
    source: DataFrame, url: str, staging: str, connections: int = 16, **options: str
) -> None:
    """Fill the staging table in parallel, in batches, over a bounded number of connections."""
    (
        source.write.format("jdbc")
        .mode("overwrite")
        .options(
            url=url,
            dbtable=staging,
            truncate="true",
            batchsize="5000",
            numPartitions=str(connections),
            **options,
        )
        .save()
    )
