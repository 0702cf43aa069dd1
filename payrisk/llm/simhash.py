"""SimHash near-duplicates with covering locality-sensitive hashing (Pagh, 2016).

A document's fingerprint takes the majority of each bit over the XXH64 values of its word shingles.
Fingerprints that differ in at most ``radius`` bits are linked. To find all of them, every bit gets a
non-zero vector of ``radius + 1`` bits; for each non-zero vector v one table keeps the bits whose
vectors are not orthogonal to v. The differing bits of a pair within the radius span less than the
whole space, so some v is orthogonal to all of them and that table's key is equal for both: no pair
is missed.

Work is done on distinct fingerprints, so copies cost nothing. A bucket of more than ``BUCKET``
fingerprints is covered again over the bits its key leaves free, which halves them each time; once
few bits are left a bucket cannot be large. So no task ever holds a large group, and no link is
lost. Buckets give the edges of a forest, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payrisk.llm.text import LOWER, NOT_SPACE, Words, row_slices
from payrisk.operators.components import connected_components
from payrisk.session import stage

BITS = 64
SEED = 42
SHINGLE = 3
RADIUS = 3
#: Fingerprints of a bucket that are compared in one task; larger buckets are covered again.
BUCKET = 256


def _fingerprints_of(column: pa.Array, shingle: int) -> np.ndarray:
    words = Words(column, NOT_SPACE)
    counts = words.per_row
    out = np.zeros(len(counts), dtype=np.uint64)
    if not len(words):
        return out
    # One blank after each word; other white space goes.
    keep = words.inside.copy()
    keep[words.ends[words.ends < len(keep)]] = True
    place = np.concatenate(([0], np.cumsum(keep)))
    text = np.where(words.inside, LOWER[words.data], 0x20)[keep].astype(np.uint8).tobytes()
    starts, ends = place[words.starts], place[words.ends]
    # The first word of each shingle; a row of fewer words is one shingle.
    n_shingles = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    bounds = np.concatenate(([0], np.cumsum(n_shingles)))
    first = np.arange(bounds[-1]) + np.repeat(words.rows[:-1] - bounds[:-1], n_shingles)
    last = first + np.repeat(np.minimum(counts, shingle), n_shingles) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(text[s:e], SEED) for s, e in zip(starts[first].tolist(), ends[last].tolist())),
        dtype=np.uint64,
        count=len(first),
    )
    some = np.flatnonzero(n_shingles)
    weights = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.add.reduceat(bits, bounds[some], axis=0, dtype=np.int64)
    majority = ones * 2 > n_shingles[some][:, None]
    out[some] = (majority * weights).sum(axis=1, dtype=np.uint64)
    return out


def fingerprints(
    docs: DataFrame, text: str = "text", shingle: int = SHINGLE, into: str = "fp"
) -> DataFrame:
    """All columns of ``docs`` but the text, and the fingerprint as a long named ``into``.

    Null, empty and blank texts have fingerprint zero. A column that is named ``into`` already is
    replaced.
    """
    rest = [c for c in docs.columns if c not in (text, into)]
    schema = docs.select(*rest).schema.add(into, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(rest))
            parts = [
                _fingerprints_of(column.slice(a, b - a), shingle) for a, b in row_slices(column)
            ]
            fps = np.concatenate(parts) if parts else np.empty(0, np.uint64)
            arrays = [batch.column(i) for i in range(len(rest))]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(fps.view(np.int64))], names=[*rest, into]
            )

    return docs.select(*rest, text).mapInArrow(run, schema)


def covering_masks(free: int, radius: int) -> list[int]:
    """Masks over the bits of ``free``: any ``radius`` of these bits are outside of some mask."""
    size = 1 << (radius + 1)
    # Unit vectors first: then every mask has a bit as soon as radius + 1 bits are free.
    vectors = sorted(range(1, size), key=lambda v: (v.bit_count() > 1, v))
    positions = [i for i in range(BITS) if free >> i & 1]
    vector = {p: vectors[i % len(vectors)] for i, p in enumerate(positions)}
    return [
        sum(1 << p for p in positions if (vector[p] & v).bit_count() & 1) for v in range(1, size)
    ]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _next_masks(spark: SparkSession, fixed: list[int], radius: int) -> DataFrame:
    """(mask, wider) for each mask of a level: at most 2^(radius+1) - 1 times as many rows."""
    full = (1 << 64) - 1
    wider = {
        (mask, _signed(mask & full | m))
        for mask in fixed
        for m in covering_masks(full & ~mask, radius)
    }
    return spark.createDataFrame(sorted(wider), "mask bigint, wider bigint")


def _keyed(rows: DataFrame) -> DataFrame:
    """(mask, key, fp). A mask holds all bits that are fixed so far, so (mask, key) is a bucket."""
    return rows.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")


def _covered(level: DataFrame, fixed: list[int], radius: int) -> DataFrame:
    """Buckets of every row (mask, fp) of ``level`` under each mask of the next level."""
    masks = F.broadcast(_next_masks(level.sparkSession, fixed, radius))
    return _keyed(level.join(masks, "mask").select(F.col("wider").alias("mask"), "fp"))


def _forest(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links (a, b) that connect what is within the radius in each bucket, as a forest."""
    for batch in batches:
        a, b = [], []
        for members in batch.column(0).to_pylist():
            fps = np.array(sorted(members), dtype=np.int64)
            near = np.bitwise_count((fps[:, None] ^ fps[None, :]).view(np.uint64)) <= radius
            left = np.ones(len(fps), dtype=bool)
            while left.any():
                todo = [int(np.argmax(left))]
                left[todo[0]] = False
                while todo:
                    at = todo.pop()
                    found = np.flatnonzero(near[at] & left)
                    left[found] = False
                    todo.extend(found.tolist())
                    a.extend([int(fps[at])] * len(found))
                    b.extend(fps[found].tolist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
        )


def near_links(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) that connect exactly those
    within ``radius`` bits, directly or over others. ``bucket`` bounds what one task compares."""
    if bucket < 1 << radius:
        raise ValueError(f"bucket must be {1 << radius} at least, else covering never ends")
    first = [F.lit(_signed(m)) for m in covering_masks((1 << BITS) - 1, radius)]
    rows, links = _keyed(fps.select(F.explode(F.array(*first)).alias("mask"), "fp")), None
    while True:
        rows = stage(rows, "covering")
        sizes = stage(
            rows.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"),
            "bucket-sizes",
        )
        few = F.col("n") <= bucket
        cold = (
            rows.join(sizes.filter(few), ["mask", "key"])
            .groupBy("mask", "key")
            .agg(F.collect_list("fp").alias("fps"))
            .select("fps")
            .mapInArrow(lambda batches: _forest(batches, radius), "a bigint, b bigint")
        )
        links = cold if links is None else links.unionByName(cold)
        hot = sizes.filter(~few).select("mask", "key")
        fixed = [r["mask"] for r in hot.select("mask").distinct().collect()]  # 15 per level
        if not fixed:
            return links
        level = rows.join(hot, ["mask", "key"]).select("mask", "fp")
        # Two masks may widen to the same one: their rows meet in one bucket.
        rows = _covered(level, fixed, radius).distinct()


def classes(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(fp, root) for the fingerprints that are linked to others; ``root`` names the component."""
    return connected_components(near_links(fps, radius, bucket)).select(
        F.col("node").alias("fp"), F.col("component").alias("root")
    )


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    bucket: int = BUCKET,
) -> DataFrame:
    """One row per document: (id, fp, component_id).

    component_id is the smallest id that links of fingerprints reach, the document's own included.
    Null, empty and blank texts share fingerprint zero and are linked like others. Repeated rows
    each keep a row. A null id is never a component's name; a component of null ids only has none.
    """
    ids = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    found = stage(fingerprints(ids, "text", shingle), "fingerprints")
    by_fp = _components(found, radius, bucket)
    return found.join(by_fp, "fp").select(F.col("doc_id").alias(id_column), "fp", "component_id")


def _components(found: DataFrame, radius: int, bucket: int) -> DataFrame:
    """(fp, root, component_id) for each fingerprint of the rows (doc_id, fp)."""
    lowest = stage(found.groupBy("fp").agg(F.min("doc_id").alias("lowest")), "by-fingerprint")
    linked = lowest.join(classes(lowest, radius, bucket), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    linked = stage(linked, "linked")
    names = stage(linked.groupBy("root").agg(F.min("lowest").alias("component_id")), "names")
    return stage(linked.join(names, "root"), "components").drop("lowest")


def keep_one(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    bucket: int = BUCKET,
) -> DataFrame:
    """``docs`` with one row left of each component: that of the smallest id (of rows that share
    it, the one with the smallest hash of its text; of equal rows any one). Columns stay."""
    text_hash = F.xxhash64(text)
    slim = docs.select(
        F.col(id_column).alias("doc_id"), text_hash.alias("h"), F.col(text).alias("text")
    )
    found = stage(fingerprints(slim, "text", shingle), "fingerprints")
    rows = found.groupBy("fp", "doc_id", "h").agg(F.count(F.lit(1)).alias("n"))
    rows = stage(
        rows.join(_components(found, radius, bucket), "fp").withColumn(
            "place", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h")
        ),
        "members",
    )
    best = stage(rows.groupBy("root").agg(F.min("place").alias("best")), "chosen")
    placed = rows.join(best, "root")
    dropped = stage(placed.filter("place != best").select("doc_id", "h"), "dropped")
    repeated = stage(placed.filter("place = best and n > 1").select("doc_id", "h"), "repeated")

    def same(other: DataFrame):
        return docs[id_column].eqNullSafe(other["doc_id"]) & (text_hash == other["h"])

    left = docs.join(dropped, same(dropped), "left_anti")
    once = left.join(repeated, same(repeated), "left_anti")
    twice = docs.join(repeated, same(repeated), "left_semi")
    return once.unionByName(twice.dropDuplicates([id_column, text]))
