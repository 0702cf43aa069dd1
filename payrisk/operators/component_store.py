"""Connected components that take in new links without the old ones.

Only (node, component) is stored, in hash buckets of the node. New links are lifted onto the
components of their ends; what they connect is worked out among these roots alone; then one join
gives the nodes of merged components their new name. Buckets without such a node keep their files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payrisk.operators.components import connected_components
from payrisk.session import stage
from payrisk.sinks import partitions

BUCKETS = 64


def _bucket(buckets: int):
    return partitions.bucket_of(["node"], buckets)


def add_links(spark: SparkSession, path: str, pairs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Take in the links of the two columns of ``pairs``; returns (node, component) of the nodes
    that are new or changed their component.

    A component's name is its lowest node, as in ``connected_components`` over all links. Links are
    only ever added. Null ends and links of a node with itself are left out.
    """
    a, b = (F.col(c) for c in pairs.columns)
    links = stage(
        pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(a.isNotNull() & b.isNotNull() & (a != b))
        .distinct(),
        "new-links",
    )
    if not partitions.exists(spark, path):
        found = stage(connected_components(links), "components")
        if not found.isEmpty():
            name = partitions.bucket_name(buckets)
            partitions.create(found.withColumn(name, _bucket(buckets)), path, name)
        return found
    buckets = partitions.buckets_of(partitions.read(spark, path))
    name = partitions.bucket_name(buckets)
    ends = links.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    ends = stage(ends.withColumn(name, _bucket(buckets)), "ends")
    looked_up = partitions.read(spark, path, name, partitions.values_in(ends, name))
    # Every end with its component; a new node is its own.
    rooted = stage(
        ends.join(looked_up.select("node", "component"), "node", "left").select(
            "node",
            F.coalesce("component", "node").alias("root"),
            F.col("component").isNull().alias("is_new"),
        ),
        "rooted",
    )
    lifted = lift(links, rooted)
    merged = connected_components(lifted)
    renamed = stage(
        merged.filter("node != component").select(
            F.col("node").alias("root"), F.col("component").alias("target")
        ),
        "renamed",
    )
    target = F.coalesce("target", "root").alias("component")
    new = rooted.filter("is_new").join(renamed, "root", "left").select("node", target)
    # Members of components that were merged into another one.
    moved = (
        partitions.read(spark, path)
        .select("node", F.col("component").alias("root"))
        .join(renamed, "root")
        .select("node", F.col("target").alias("component"))
    )
    changed = stage(new.unionByName(moved).withColumn(name, _bucket(buckets)), "changed")
    touched = partitions.values_in(changed, name)
    if touched:
        kept = partitions.read(spark, path, name, touched).join(changed.select("node"), "node", "left_anti")
        partitions.replace(
            kept.select("node", "component", name).unionByName(changed.select("node", "component", name)),
            path,
            name,
            touched,
        )
    return changed.select("node", "component")


def lift(links: DataFrame, rooted: DataFrame) -> DataFrame:
    """Links (u, v) as links between the roots of their ends, without those inside a component."""
    u = rooted.select(F.col("node").alias("u"), F.col("root").alias("a"))
    v = rooted.select(F.col("node").alias("v"), F.col("root").alias("b"))
    return links.join(u, "u").join(v, "v").select("a", "b").filter("a != b").distinct()


def read(spark: SparkSession, path: str) -> DataFrame:
    """(node, component)."""
    if not partitions.exists(spark, path):
        return spark.createDataFrame([], "node string, component string")
    return partitions.read(spark, path).select("node", "component")
