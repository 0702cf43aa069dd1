"""Approximate nearest neighbours with a hierarchical k-means tree.

The tree is fitted to a bounded sample; every vector goes down it to a leaf. A query visits leaves
best bin first: a priority queue holds the branches it has passed by the distance of their centres,
and the nearest is taken next. How many leaves are visited is calibrated: some queries are compared
with all vectors, and visits widen until the neighbours found reach the recall asked for.

Equal vectors are one entry with its smallest ids, so any number of copies costs as much as one
row. Leaves are cut into blocks of bounded size, queries too; blocks meet in a join on the leaf.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payrisk.session import stage

NEAREST = 10
#: Vectors the tree is fitted to, at most.
SAMPLE = 40_000
BRANCHES = 8
#: Rows a leaf should hold; beyond ``MAX_LEAVES`` leaves they hold more, in more blocks.
LEAF_ROWS = 1_000
MAX_LEAVES = 4_096
BLOCK = 4_096
QUERY_BLOCK = 512
RECALL = 0.97
#: Queries that are compared with all vectors to calibrate the visits.
CALIBRATION = 64


@dataclass
class Tree:
    """Nodes as arrays: centres, children (none for leaves), and each leaf's number."""

    centers: np.ndarray
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)

    @property
    def leaves(self) -> int:
        return max(self.leaf) + 1

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of each vector: the nearest child at every node."""
        out = np.zeros(len(vectors), dtype=np.int64)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            below = self.children[node]
            if not below:
                out[rows] = self.leaf[node]
                continue
            nearest = np.argmin(_squares(vectors[rows], self.centers[below]), axis=1)
            todo += [(c, rows[nearest == k]) for k, c in enumerate(below) if (nearest == k).any()]
        return out

    def visits(self, query: np.ndarray, most: int) -> list[int]:
        """The first leaves that best-bin-first search takes."""
        queue, found = [(0.0, 0)], []
        while queue and len(found) < most:
            node = heapq.heappop(queue)[1]
            while self.children[node]:
                below = self.children[node]
                far = ((self.centers[below] - query) ** 2).sum(axis=1)
                best = int(np.argmin(far))
                for k, child in enumerate(below):
                    if k != best:
                        heapq.heappush(queue, (float(far[k]), child))
                node = below[best]
            found.append(self.leaf[node])
        return found


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances up to rounding."""
    return (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T)


def _cluster(x: np.ndarray, k: int, rounds: int, pick: np.random.Generator) -> np.ndarray:
    """Centres of k-means; fewer if there are fewer distinct vectors."""
    centers = np.unique(x[pick.permutation(len(x))[: k * 4]], axis=0)
    centers = centers[pick.permutation(len(centers))[:k]]
    for _ in range(rounds):
        of = np.argmin(_squares(x, centers), axis=1)
        used = np.unique(of)
        centers = np.array([x[of == j].mean(axis=0) for j in used])
    return centers


def fit_tree(sample: np.ndarray, leaves: int, branches: int = BRANCHES, rounds: int = 8) -> Tree:
    """Tree with about ``leaves`` leaves of about equal shares of the sample."""
    pick = np.random.default_rng(0)
    centers = [sample.mean(axis=0) if len(sample) else np.zeros(sample.shape[1])]
    tree = Tree(np.empty(0), [[]], [-1])
    share = max(len(sample) / max(leaves, 1), 1.0)
    todo = [(0, np.arange(len(sample)))]
    while todo:
        node, rows = todo.pop(0)
        if len(rows) < 1.5 * share:
            continue
        parts = int(min(branches, max(2, round(len(rows) / share))))
        found = _cluster(sample[rows], parts, rounds, pick)
        if len(found) < 2:
            continue
        of = np.argmin(_squares(sample[rows], found), axis=1)
        for k in range(len(found)):
            child = len(centers)
            centers.append(found[k])
            tree.children.append([])
            tree.leaf.append(-1)
            tree.children[node].append(child)
            todo.append((child, rows[of == k]))
    tree.centers = np.array(centers)
    for number, node in enumerate(n for n, below in enumerate(tree.children) if not below):
        tree.leaf[node] = number
    return tree


def _nearest(queries: np.ndarray, vectors: np.ndarray, k: int) -> list[np.ndarray]:
    """Per query the places of the k nearest vectors, and of any as near up to rounding."""
    far = _squares(queries, vectors)
    if far.shape[1] <= k:
        return [np.arange(far.shape[1])] * len(queries)
    border = np.partition(far, k - 1, axis=1)[:, k - 1]
    scale = (queries * queries).sum(axis=1) + np.abs(border) + (vectors * vectors).sum(axis=1).max()
    return [np.flatnonzero(f <= b + 1e-12 * s) for f, b, s in zip(far, border, scale)]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(-1, dim)


def usable(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(vec_id, vec): vectors as doubles. Null ids, and vectors that are null, empty or zero or hold
    null or non-finite components, are left out."""
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("vec"),
    )
    finite = F.forall(
        "vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return rows.filter(
        F.col("vec_id").isNotNull() & finite & F.exists("vec", lambda x: x != F.lit(0.0))
    )


def _located(rows: DataFrame, tree) -> DataFrame:
    """(vec_id, leaf, raw): the bytes of each vector and its leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            if not len(lists):
                continue
            # + 0.0 turns -0.0 into 0.0: equal vectors have equal bytes.
            matrix = lists.flatten().to_numpy().reshape(len(lists), -1) + 0.0
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(tree.value.assign(matrix)),
                    pa.array([row.tobytes() for row in matrix], pa.binary()),
                ],
                names=["vec_id", "leaf", "raw"],
            )

    return rows.mapInArrow(run, "vec_id bigint, leaf bigint, raw binary")


@dataclass
class Index:
    """Stored entries (leaf, raw, ids) of distinct vectors, their blocks, and the tree."""

    tree: Tree
    shared: object
    entries: DataFrame
    blocks: DataFrame
    located: DataFrame
    dim: int
    nearest: int


def build_index(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    nearest: int = NEAREST,
    sample_size: int = SAMPLE,
    leaf_rows: int = LEAF_ROWS,
    max_leaves: int = MAX_LEAVES,
    block: int = BLOCK,
    dim: int | None = None,
) -> Index | None:
    """Index of all usable vectors of ``dim`` components, or else of the commonest length; None if
    there are none. Vectors of different lengths have no distance, so each length has its tree."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_column, vector)
    if dim is not None:
        rows = rows.filter(F.size("vec") == dim)
    lengths = rows.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), "dim").first()
    if common is None:
        return None
    dim, total = common["dim"], common["n"]
    rows = rows.filter(F.size("vec") == dim)
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_size).select("vec").toArrow()
    sample = picked.column("vec").combine_chunks().flatten().to_numpy().reshape(-1, dim)
    tree = fit_tree(sample, min(max(total // leaf_rows, 1), max_leaves))
    shared = spark.sparkContext.broadcast(tree)
    located = stage(_located(rows, shared), "located")
    # Ids of a vector beyond its smallest can be nobody's neighbour by the order of ties. Rows that
    # repeat an id with its vector are one: they must not take the places of other ids.
    first = F.row_number().over(Window.partitionBy("raw").orderBy("vec_id"))
    entries = stage(
        located.distinct()
        .withColumn("n", first)
        .filter(F.col("n") <= nearest + 1)
        .groupBy("raw")
        .agg(F.min("leaf").alias("leaf"), F.array_sort(F.collect_list("vec_id")).alias("ids")),
        "entries",
    )
    sizes = entries.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
    salted = entries.join(F.broadcast(sizes), "leaf").withColumn(
        "part", F.pmod(F.xxhash64("raw"), F.ceil(F.col("n") / block))
    )
    blocks = stage(
        salted.groupBy("leaf", "part").agg(
            F.collect_list("raw").alias("raws"), F.collect_list("ids").alias("ids")
        ),
        "blocks",
    )
    return Index(tree, shared, entries, blocks, located, dim, nearest)


def _best(
    queries: np.ndarray, vectors: np.ndarray, ids: list[list[int]], k: int
) -> Iterator[tuple[int, list[tuple[float, int]]]]:
    """Per query number its k best (distance, id), by exact distance, then id."""
    for q, places in enumerate(_nearest(queries, vectors, k)):
        exact = np.sqrt(((vectors[places] - queries[q]) ** 2).sum(axis=1))
        pairs = [(float(d), i) for d, p in zip(exact, places) for i in ids[p]]
        yield q, heapq.nsmallest(k, pairs)


def _exact(index: Index, queries: np.ndarray, k: int) -> list[list[tuple[float, int, int]]]:
    """(distance, id, leaf) of the k nearest of all vectors, for a few queries."""
    dim = index.dim

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = _matrix(batch.column(0), dim)
            leaves, ids = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            leaf_of = {i: leaf for leaf, own in zip(leaves, ids) for i in own}
            out = [
                (q, d, i, leaf_of[i])
                for q, pairs in _best(queries, matrix, ids, k)
                for d, i in pairs
            ]
            yield pa.RecordBatch.from_pydict(
                dict(zip(("q", "d", "i", "leaf"), (list(c) for c in zip(*out))))
            )

    found = index.entries.select("raw", "leaf", "ids").mapInArrow(
        run, "q bigint, d double, i bigint, leaf bigint"
    )
    rank = F.row_number().over(Window.partitionBy("q").orderBy("d", "i"))
    out: list[list[tuple[float, int, int]]] = [[] for _ in queries]
    for r in found.withColumn("n", rank).filter(F.col("n") <= k).orderBy("q", "n").collect():
        out[r["q"]].append((r["d"], r["i"], r["leaf"]))
    return out


def calibrate(
    index: Index, queries: DataFrame, recall: float = RECALL, size: int = CALIBRATION
) -> int:
    """The least number of leaves to visit with which a hashed choice of ``queries`` (raw) finds
    that share of its true neighbours."""
    picked = queries.select("raw").distinct().orderBy(F.xxhash64("raw"), "raw").limit(size)
    raws = [bytes(r["raw"]) for r in picked.collect()]
    if not raws:
        return 1
    matrix = np.frombuffer(b"".join(raws), dtype="<f8").reshape(-1, index.dim)
    true = _exact(index, matrix, index.nearest + 1)
    needed = []
    for query, near in zip(matrix, true):
        order = {leaf: n + 1 for n, leaf in enumerate(index.tree.visits(query, index.tree.leaves))}
        needed += [order[leaf] for _, _, leaf in near]
    needed.sort()
    return needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]


def search(
    vectors: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector: str = "embedding",
    nearest: int = NEAREST,
    recall: float = RECALL,
    query_block: int = QUERY_BLOCK,
    **build,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``nearest`` vectors found for each row where
    ``is_query`` (a condition on vec_id) holds, nearest first, ties to the smaller id.

    score is the Euclidean distance in doubles. A row is not its own neighbour; rows that share its
    id are not either. All usable vectors are in the index; with fewer of them, lists are shorter.
    Vectors of several lengths are searched length by length, those that queries have: a query's
    neighbours have its length. An id with queries of two lengths has a list for each.
    """
    spark = vectors.sparkSession
    asked = usable(vectors, id_column, vector).filter(is_query)
    dims = [r["dim"] for r in asked.select(F.size("vec").alias("dim")).distinct().collect()]
    found = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for number, dim in enumerate(sorted(dims)):
        index = build_index(vectors, id_column, vector, nearest, dim=dim, **build)
        one = _search(index, is_query, nearest, recall, query_block)
        found = found.unionByName(one) if number else one
    return found


def _search(
    index: Index, is_query: Column, nearest: int, recall: float, query_block: int
) -> DataFrame:
    """The search among the vectors of one length."""
    asked = stage(index.located.filter(is_query).select("vec_id", "raw").distinct(), "queries")
    visits = calibrate(index, asked, recall)
    # ``is_query`` looks at the id, so all vectors of a query's id are here: so many places of its
    # list can be its own.
    own = asked.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    shared, dim, k = index.shared, index.dim, nearest + (own or 1)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws, leaves = [], []
            for raw in batch.column(0).to_pylist():
                found = shared.value.visits(np.frombuffer(raw, dtype="<f8"), visits)
                raws += [raw] * len(found)
                leaves += found
            yield pa.RecordBatch.from_arrays(
                [pa.array(raws, pa.binary()), pa.array(leaves, pa.int64())], names=["raw", "leaf"]
            )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                own = batch.column(0)[row].values
                queries = _matrix(own, dim)
                matrix = _matrix(batch.column(1)[row].values, dim)
                ids = batch.column(2)[row].as_py()
                names = own.to_pylist()
                best = [[{"d": d, "i": i} for d, i in p] for _, p in _best(queries, matrix, ids, k)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.binary()),
                        pa.array(
                            best, pa.list_(pa.struct([("d", pa.float64()), ("i", pa.int64())]))
                        ),
                    ],
                    names=["raw", "best"],
                )

    visited = stage(
        asked.select("raw").distinct().mapInArrow(visit, "raw binary, leaf bigint"), "visited"
    )
    per_leaf = visited.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
    groups = stage(
        visited.join(F.broadcast(per_leaf), "leaf")
        .withColumn("part", F.pmod(F.xxhash64("raw"), F.ceil(F.col("n") / query_block)))
        .groupBy("leaf", "part")
        .agg(F.collect_list("raw").alias("queries")),
        "query-blocks",
    )
    best = (
        groups.select("leaf", "queries")
        .join(index.blocks.select("leaf", "raws", "ids"), "leaf")
        .select("queries", "raws", "ids")
        .mapInArrow(compare, "raw binary, best array<struct<d:double,i:bigint>>")
    )
    rank = F.row_number().over(Window.partitionBy("raw").orderBy("b.d", "b.i"))
    lists = stage(
        best.select("raw", F.explode("best").alias("b"))
        .withColumn("n", rank)
        .filter(F.col("n") <= k)
        .groupBy("raw")
        .agg(F.array_sort(F.collect_list("b")).alias("best")),
        "lists",
    )
    own = asked.join(lists, "raw").select(
        F.col("vec_id").alias("query_id"),
        F.slice(F.filter("best", lambda b: b["i"] != F.col("vec_id")), 1, nearest).alias("best"),
    )
    return own.select("query_id", F.posexplode("best").alias("at", "b")).select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("b.i").alias("vec_id"),
        F.col("b.d").alias("score"),
    )
