"""Connected components by alternating star contraction (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payrisk.session import stage


def _hang_on(links: DataFrame, lowest: DataFrame) -> DataFrame:
    """Join each link (u, v) with the lowest node known to u.

    ``lowest`` is stored first: then both sides of the join are plain shuffles, and AQE can split
    the links of a node that holds a large share of them.
    """
    return links.join(stage(lowest, "lowest"), "u")


def _large_star(links: DataFrame) -> DataFrame:
    """Move every neighbour above u to the lowest node around u."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        _hang_on(both.filter(F.col("v") > F.col("u")), lowest)
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Move u and every neighbour below it to the lowest of them. Links come as u > v."""
    lowest = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = _hang_on(links, lowest).select(
        F.explode(
            F.array(
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            )
        ).alias("l")
    )
    return moved.select("l.u", "l.v").filter(F.col("u") != F.col("v")).distinct()


def _fingerprint(links: DataFrame) -> tuple[int, int]:
    row = links.agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")
    ).first()
    return row["n"], row["x"] or 0


def connected_components(pairs: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """(node, component) for the graph of the two columns of ``pairs``; a component's name is its
    lowest node.

    Runs until the links settle. That needs a number of rounds that grows with the logarithm of the
    component size, not with its diameter, and never more links than the input has. Both halves of
    a round end in a stored table, so a lost executor costs one step and plans stay short. A caller
    may set ``max_rounds``; it is an error if they do not suffice.
    """
    a, b = (F.col(c) for c in pairs.columns)
    links = stage(
        pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(F.col("u") != F.col("v"))
        .distinct(),
        "links",
    )
    before, rounds = _fingerprint(links), 0
    while True:
        if max_rounds is not None and rounds >= max_rounds:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        large = stage(_large_star(links), "large-star")
        links = stage(_small_star(large), "small-star")
        after, rounds = _fingerprint(links), rounds + 1
        if after == before:
            break
        before = after
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
