"""Silver kept up to date: an increment of bronze rows recomputes only the days that it reaches.

Three tables below one folder:

* ``rows``: the deduplicated payments with their card features, a partition per day;
* ``pairs``: how many payments each (device, card) pair has, in hash buckets of the pair;
* ``devices``: how many cards each device has, in hash buckets of the device.

A payment changes the card features of the hour after it, so it reaches its own day and, in a day's
last hour, the next one. The count of a device's cards runs over all time: it is kept apart and
joined when silver is read, so a new card on an old device rewrites one bucket and no payment.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payrisk.functions.values import epoch_second
from payrisk.operators.card_windows import LONGEST_S, SLICE_S, card_features
from payrisk.operators.dedup import first_per_key
from payrisk.plans.silver import deduplicated
from payrisk.schemas import EVENT_COLUMNS, SILVER_COLUMNS
from payrisk.session import stage
from payrisk.sinks import aggregates, partitions

DAY = "day"
COUNT = "distinct_cards_per_device"


@dataclass
class Change:
    """What an increment did: the days whose rows it replaced, and (device_id, before, after) of
    the devices whose number of cards changed."""

    days: list[int]
    devices: DataFrame


def day_of(seconds: Column) -> Column:
    """The number of the day since the epoch."""
    return F.floor(seconds / SLICE_S).cast("int")


def _second() -> Column:
    return epoch_second(F.col("event_time"))


def rows(spark: SparkSession, root: str) -> DataFrame:
    """Payments with card features and their day."""
    return partitions.read(spark, f"{root}/rows")


def devices(spark: SparkSession, root: str) -> DataFrame:
    """(device_id, n_cards)."""
    return aggregates.read(spark, f"{root}/devices", "device_id string, n_cards bigint")


def silver(spark: SparkSession, root: str, days: list[int] | None = None) -> DataFrame:
    """The silver table with its ``day``, or only some days of it."""
    counts = devices(spark, root).select(F.col("device_id").alias("key_device"), "n_cards")
    payments = partitions.read(spark, f"{root}/rows", DAY, days)
    match = F.col("device_id").eqNullSafe(F.col("key_device"))
    counted = payments.join(counts, match, "left").withColumn(
        COUNT, F.coalesce(F.col("n_cards"), F.lit(0)).cast("int")
    )
    return counted.select(*SILVER_COLUMNS, DAY)


def update(
    spark: SparkSession, root: str, bronze: DataFrame, buckets: int = aggregates.BUCKETS
) -> Change:
    """Take in an increment of bronze rows; the first one founds the store.

    The same payment may come again, in any later increment: as in a run over all rows the earliest
    stays, so a late copy with an earlier time replaces the stored payment, wherever that lies. Of
    the old rows only ids and days are read, the days of such payments, and the days recomputed.
    Increments are taken in one after the other. After a run that was cut off between the tables,
    ``recount`` makes the counts again from the rows. ``buckets`` is taken when the store is founded.
    """
    fresh = stage(deduplicated(bronze), "increment")
    path = f"{root}/rows"
    if fresh.isEmpty():
        return Change([], spark.createDataFrame([], "device_id string, before bigint, after bigint"))
    if not partitions.exists(spark, path):
        whole = card_features(fresh).withColumn(DAY, day_of(_second()))
        partitions.create(whole, path, DAY)
        return Change(partitions.values_in(rows(spark, root), DAY), _count(spark, root, fresh, None, buckets))
    added, removed = _settled(spark, path, fresh)
    reached = added.unionByName(removed).select(
        F.explode(
            F.array_distinct(F.array(day_of(_second()), day_of(_second() + LONGEST_S)))
        ).alias(DAY)
    )
    touched = partitions.values_in(reached, DAY)
    if touched:
        partitions.replace(_recomputed(spark, path, touched, added, removed), path, DAY, touched)
    return Change(touched, _count(spark, root, added, removed, buckets))


def _settled(spark: SparkSession, path: str, fresh: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(added, removed): the increment's payments that stay, and the stored ones they replace."""
    ids = fresh.select("payment_id")
    seen = stage(
        partitions.read(spark, path).select("payment_id", DAY).join(ids, "payment_id", "left_semi"),
        "seen",
    )
    days = partitions.values_in(seen, DAY)
    old = stage(
        partitions.read(spark, path, DAY, days)
        .join(seen.select("payment_id"), "payment_id", "left_semi")
        .select(*EVENT_COLUMNS),
        "stored-before",
    )
    # Of equal rows the stored one stays: false sorts before true.
    both = old.withColumn("is_new", F.lit(False)).unionByName(fresh.withColumn("is_new", F.lit(True)))
    first = first_per_key(both, ["payment_id"], ["event_time"])
    added = stage(first.filter("is_new").drop("is_new"), "added")
    removed = old.join(added.select("payment_id"), "payment_id", "left_semi").select(*EVENT_COLUMNS)
    return added, stage(removed, "removed")


def _recomputed(
    spark: SparkSession, path: str, touched: list[int], added: DataFrame, removed: DataFrame
) -> DataFrame:
    """The rows of the touched days. Of the day before each one the frames need the last hour."""
    needed = sorted({d - back for d in touched for back in (0, 1)})
    near = F.col(DAY).isin(*touched) | (_second() >= (F.col(DAY) + 1) * SLICE_S - LONGEST_S)
    kept = (
        partitions.read(spark, path, DAY, needed)
        .filter(near)
        .select(*EVENT_COLUMNS)
        .join(removed.select("payment_id"), "payment_id", "left_anti")
        .select(*EVENT_COLUMNS)
    )
    around = stage(kept.unionByName(added), "around")
    day = day_of(_second())
    return card_features(around).withColumn(DAY, day).filter(F.col(DAY).isin(*touched))


def _count(
    spark: SparkSession, root: str, added: DataFrame, removed: DataFrame | None, buckets: int
) -> DataFrame:
    """Add the increment's pairs; returns (device_id, before, after) of the devices that changed.

    Pairs are counted map-side, so a busy device travels as its cards; the pairs lie in buckets of
    both ids, so it is not one bucket either. A device gains a card when a pair appears, and loses
    one when the pair's last payment goes."""
    changes = added.select("device_id", "card_id", F.lit(1).alias("n"))
    if removed is not None:
        changes = changes.unionByName(removed.select("device_id", "card_id", F.lit(-1).alias("n")))
    pairs = aggregates.add(
        spark,
        f"{root}/pairs",
        changes.filter(F.col("card_id").isNotNull()),
        ["device_id", "card_id"],
        "n",
        buckets,
    )
    gained = pairs.select(
        "device_id", ((F.col("after") > 0).cast("long") - (F.col("before") > 0).cast("long")).alias("n_cards")
    )
    changed = aggregates.add(spark, f"{root}/devices", gained, ["device_id"], "n_cards", buckets)
    return changed.filter("before != after")


def recount(spark: SparkSession, root: str, buckets: int = aggregates.BUCKETS) -> None:
    """Make pairs and devices again from the rows."""
    for name in ("pairs", "devices"):
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    _count(spark, root, rows(spark, root), None, buckets)
