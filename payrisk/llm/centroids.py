"""Centroid clustering of integer vectors by scalar lookup tables (Lloyd's rounds).

Vectors become whole numbers once and are stored in slices: per dimension the values that occur in
the slice, and per vector the number of its value. Each round tabulates, for every dimension,
occurring value and centroid, the squared difference; a vector's distances are then gathers from
these tables and sums, all in integers, so every result is exact whatever the partitioning.

Only the centroids and, per task, the sums of each cluster travel. A slice bounds the tables: they
have at most as many values a dimension as the slice has vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payrisk.session import stage

DIM = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = "3"
#: Vectors of a slice.
SLICE = 8192
#: Largest absolute component: beyond it the squared distance of two vectors need not fit a long.
LARGEST = 1 << 27


def usable(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    dim: int = DIM,
    scale: int = SCALE,
) -> DataFrame:
    """(vec_id, v): the vectors of ``dim`` finite components as integers floor(scale * x)."""
    x = F.col(vector)
    finite = F.forall(
        x,
        lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")),
    )
    # The product of a large double may be infinite; LARGEST bounds it like any large component.
    most = F.lit(float(LARGEST))
    whole = F.transform(
        x,
        lambda c: F.floor(
            F.greatest(F.least(c.cast("double") * F.lit(float(scale)), most), -most)
        ).cast("int"),
    )
    return vectors.filter((F.size(x) == dim) & finite).select(
        F.col(id_column).alias("vec_id"), whole.alias("v")
    )


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _slices(rows: DataFrame, dim: int) -> DataFrame:
    """(ids, sizes, codes, values) of each slice: per dimension the sorted occurring values, and
    the place there of each vector's component, dimension by dimension."""
    kind = rows.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                columns = _matrix(batch.column(1), dim).T
                values, codes = zip(*(np.unique(c, return_inverse=True) for c in columns))
                ids = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(0))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array([[len(v) for v in values]], pa.list_(pa.int32())),
                        pa.array([np.stack(codes).astype("<u2").tobytes()]),
                        pa.array([np.concatenate(values).astype("<i4").tobytes()]),
                    ],
                    names=["ids", "sizes", "codes", "values"],
                )

    return rows.mapInArrow(
        run, f"ids array<{kind}>, sizes array<int>, codes binary, values binary"
    )


def _decoded(batch: pa.RecordBatch, dim: int) -> Iterator[tuple[pa.Array, np.ndarray, list[np.ndarray]]]:
    """(ids, codes by dimension, occurring values of each dimension) of each slice of a batch."""
    names = {name: i for i, name in enumerate(batch.schema.names)}
    for row in range(batch.num_rows):
        sizes = batch.column(names["sizes"])[row].as_py()
        codes = np.frombuffer(batch.column(names["codes"])[row].as_py(), dtype="<u2").reshape(dim, -1)
        values = np.frombuffer(batch.column(names["values"])[row].as_py(), dtype="<i4")
        cuts = np.cumsum(sizes)[:-1]
        ids = batch.column(names["ids"])[row].values if "ids" in names else None
        yield ids, codes, np.split(values.astype(np.int64), cuts)


def distances(codes: np.ndarray, values: list[np.ndarray], centroids: np.ndarray) -> np.ndarray:
    """Squared distances (centroid, vector): a table of squared differences for each dimension,
    gathered by the vectors' codes and summed."""
    total = np.zeros((len(centroids), codes.shape[1]), dtype=np.int64)
    for d, occurring in enumerate(values):
        table = (occurring[None, :] - centroids[:, d, None]) ** 2
        total += table[:, codes[d]]
    return total


def _round(slices: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: exact floors of the means; empty ones stay."""
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dim), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            for _, codes, values in _decoded(batch, dim):
                nearest = distances(codes, values, centroids).argmin(axis=0)
                counts += np.bincount(nearest, minlength=k)
                for d, occurring in enumerate(values):
                    # How often each cluster meets each value, times the value.
                    met = np.bincount(
                        nearest * len(occurring) + codes[d], minlength=k * len(occurring)
                    )
                    sums[:, d] += met.reshape(k, -1) @ occurring
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(k), dim)),
                pa.array(np.tile(np.arange(dim), k)),
                pa.array(sums.ravel()),
                pa.array(np.repeat(counts, dim)),
            ],
            names=["cluster", "d", "s", "n"],
        )

    # A table of clusters x dimensions rows comes back, whatever the number of vectors.
    summed = (
        slices.select("sizes", "codes", "values")
        .mapInArrow(run, "cluster long, d long, s long, n long")
        .groupBy("cluster", "d")
        .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
        .filter("n > 0")
    )
    after = centroids.copy()
    for r in summed.collect():
        after[r["cluster"], r["d"]] = int(r["s"]) // r["n"]
    return after


def first_centroids(rows: DataFrame, clusters: int = CLUSTERS, seed: str = SEED) -> np.ndarray:
    """The vectors with the smallest sha256 of ``seed:id``; of equal ids by their components."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    picked = rows.select(key.alias("key"), "v").orderBy(F.asc_nulls_last("key"), "v").limit(clusters)
    found = [r["v"] for r in picked.orderBy(F.asc_nulls_last("key"), "v").collect()]
    return np.array(found, dtype=np.int64)


def cluster(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    dim: int = DIM,
    scale: int = SCALE,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: str = SEED,
) -> DataFrame:
    """One row per usable vector: (id, cluster, distance, cluster_inertia, inertia, centroid).

    Vectors null, of another length or with null or non-finite components take no part. Repeated
    rows are vectors of their own; of equal vectors any number of copies is one centroid each at the
    start, and ties go to the smaller cluster. Fewer vectors than clusters: as many clusters as
    vectors. Components beyond LARGEST in absolute value count as LARGEST, since no long holds their
    distances. An empty table gives no rows. Null ids are kept, last in the choice of centroids.
    """
    rows = stage(usable(vectors, id_column, vector, dim, scale), "whole-vectors")
    kind = rows.schema["vec_id"].dataType.simpleString()
    columns = ["cluster_inertia", "inertia", "centroid"]
    centroids = first_centroids(rows, clusters, seed)
    if not len(centroids):
        return rows.selectExpr(
            f"vec_id AS `{id_column}`",
            "0 AS cluster",
            *(f"0L AS {c}" for c in ["distance", *columns[:2]]),
            "v AS centroid",
        )
    slices = stage(_slices(rows, dim), "coded-vectors")
    for _ in range(rounds):
        centroids = _round(slices, centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, codes, values in _decoded(batch, dim):
                total = distances(codes, values, centroids)
                nearest = total.argmin(axis=0)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(nearest.astype(np.int32)), pa.array(total.min(axis=0))],
                    names=["vec_id", "cluster", "distance"],
                )

    assigned = stage(
        slices.mapInArrow(run, f"vec_id {kind}, cluster int, distance long"), "assigned"
    )
    inertia = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    whole = sum(inertia.values())
    per_cluster = assigned.sparkSession.createDataFrame(
        [(c, s, whole, [int(x) for x in centroids[c]]) for c, s in sorted(inertia.items())],
        "cluster int, cluster_inertia long, inertia long, centroid array<int>",
    )
    # At most ``clusters`` rows.
    return assigned.join(F.broadcast(per_cluster), "cluster").select(
        F.col("vec_id").alias(id_column), "cluster", "distance", *columns
    )
