"""Prefix trie of conversations from a sorted order, without building a tree.

A conversation is the string of its turns' 128-bit hashes. Sorted, the conversations that share a
prefix stand together. With the longest common prefixes (LCPs) of neighbours in a sparse table of
minima, each candidate prefix of d turns finds the left and the right end of its run by two binary
searches of their own; what a node needs to know of its run or its subtree is then a difference of
prefix sums over the order, or a minimum from a second sparse table.

Ranges cut the order into tasks, and tasks into blocks; tables hold one block. A run that touches the
end of its block may go on in the next one: such runs come as pieces. Pieces of a node add up, but for
what a cut makes two of: the common prefix of the two conversations beside it. So a correction per
cut and depth goes into the same sum. Only these pieces are shuffled, not the nodes inside blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payrisk.session import stage

#: Conversations share turns with the one whose id is rounded down to a multiple of this.
FAMILY = 100
#: Shared turns are fewer than this; see ``rebuilt``.
MOST_SHARED = 6
#: Turns of a block of sorted conversations, and at most so many conversations.
BLOCK_TURNS = 1 << 18
BLOCK_ROWS = 1 << 15
#: Bytes of a turn's hash.
WIDTH = 16

_NODE = [
    ("kind", "string"), ("id", "binary"), ("parent_id", "binary"), ("conv_id", "bigint"),
    ("depth", "bigint"), ("parent_conv_id", "bigint"), ("n_convs", "bigint"),
    ("n_children", "bigint"), ("n_leaves", "bigint"), ("saved_tokens", "bigint"),
    ("ends_sha256", "string"), ("ends", "string"), ("part", "int"), ("block", "bigint"),
    ("seq", "binary"), ("sizes", "array<bigint>"),
]
SCHEMA = ", ".join(f"{name} {kind}" for name, kind in _NODE)
_ARROW = pa.schema(
    [
        (name, {"string": pa.string(), "binary": pa.binary(), "bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.list_(pa.int64())))
        for name, kind in _NODE
    ]
)
NO_ENDS = hashlib.sha256(b"").hexdigest()
COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "ends_sha256",
]


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): of each conversation the ordered (hash, size) of its turns.

    Order is by turn, nulls first, then role and text's hash. Null role and text are empty; rows
    without conv_id belong to no conversation. Texts are hashed before anything is gathered: a turn
    takes some 40 bytes here.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    key = F.md5(F.concat_ws(":", F.length(role), role, text).cast("binary"))
    turn = F.struct(
        F.col("turn").alias("turn"),
        role.alias("role"),
        F.unhex(key).alias("key"),
        F.char_length(text).cast("long").alias("size"),
    )
    return (
        turns.filter(F.col("conv_id").isNotNull())
        .select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("t")).alias("turns"))
        .select("conv_id", F.transform("turns", lambda t: F.struct(t["key"], t["size"])).alias("turns"))
    )


def rebuilt(convs: DataFrame) -> DataFrame:
    """Conversations that begin like the first of their family: the first h turns of conversation
    ``c - c % FAMILY`` (none if it is absent; the remainder has the sign of c), then their own after
    the first h; h = crc32(c) % 6."""
    convs = stage(convs, "conversations")
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = convs.filter(F.col("conv_id") == first).select(
        F.col("conv_id").alias("family"), F.slice("turns", 1, MOST_SHARED - 1).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % MOST_SHARED).cast("int")
    none = F.slice("turns", 1, 0)
    return (
        convs.withColumn("family", first)
        .join(heads, "family", "left")
        .select(
            "conv_id",
            F.concat(
                F.slice(F.coalesce("head", none), F.lit(1), h),
                F.slice("turns", h + 1, F.size("turns")),
            ).alias("turns"),
        )
    )


def common_turns(a: bytes, b: bytes) -> int:
    """How many turns two sequences share from their start."""
    most = min(len(a), len(b)) // WIDTH
    if a[: most * WIDTH] == b[: most * WIDTH]:
        return most
    low = 0
    while most - low > 1:
        half = (low + most) // 2
        if a[: half * WIDTH] == b[: half * WIDTH]:
            low = half
        else:
            most = half
    return low


def prefix_ids(seq: bytes, depth: int) -> list[bytes]:
    """A hash for each of the prefixes of 0 to ``depth`` turns."""
    seen = hashlib.md5(usedforsecurity=False)
    ids = [seen.digest()]
    for d in range(depth):
        seen.update(seq[d * WIDTH : (d + 1) * WIDTH])
        ids.append(seen.digest())
    return ids


class SparseTable:
    """Minima of all runs whose length is a power of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while (step := 1 << (len(self.levels) - 1)) * 2 <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-step], last[step:]))

    def minimum(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Minima from left to right, both included."""
        power = np.frexp((right - left + 1).astype(np.float64))[1] - 1
        out = np.empty(len(left), dtype=self.levels[0].dtype)
        for k in np.unique(power):
            at = np.flatnonzero(power == k)
            level = self.levels[k]
            out[at] = np.minimum(level[left[at]], level[right[at] - (1 << int(k)) + 1])
        return out

    def right_end(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Binary search for the first place from ``start`` on whose value is below ``least``."""
        at = start.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            inside = at < len(level)
            jump = inside & (level[np.where(inside, at, 0)] >= least)
            at += jump.astype(np.int64) << k
        return at

    def left_end(self, end: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Binary search for the last place up to ``end`` whose value is below ``least``."""
        at = end.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level, begin = self.levels[k], at - (1 << k) + 1
            inside = begin >= 0
            jump = inside & (level[np.where(inside, begin, 0)] >= least)
            at -= jump.astype(np.int64) << k
        return at


def _batch(columns: dict[str, pa.Array], n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in _ARROW], schema=_ARROW
    )


def _copies(lcp: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How many conversations from each one on are equal to it."""
    n = len(lcp)
    begins = np.ones(n, dtype=bool)
    begins[1:] = (lcp[1:] != lengths[1:]) | (lengths[:-1] != lengths[1:])
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], n)
    return np.repeat(ends, ends - starts) - np.arange(n)


def _nodes(
    ids: np.ndarray, seqs: list[bytes], sizes: np.ndarray, part: int, block: int
) -> pa.RecordBatch:
    """The nodes of a block of sorted conversations, those that touch its ends as pieces.
    ``sizes`` are the turns' sizes of all conversations in a row."""
    n = len(seqs)
    lengths = np.array([len(s) // WIDTH for s in seqs], dtype=np.int64)
    lcp = np.array([-1, *map(common_turns, seqs[:-1], seqs[1:])], dtype=np.int64)
    minima, smallest = SparseTable(lcp), SparseTable(ids)
    # Candidates: every prefix of every conversation, the empty one included. Of equal ones the
    # first stays: the one where the run begins.
    width = lengths + 1
    offset = np.concatenate(([0], np.cumsum(width)))
    row = np.repeat(np.arange(n), width)
    depth = np.arange(offset[-1]) - offset[row]
    left = minima.left_end(row, depth)
    own = left == row
    left, depth = left[own], depth[own]
    right = minima.right_end(left + 1, depth) - 1
    count = right - left + 1

    # Characters up to each candidate, and up to what a conversation shares with the one before.
    chars = np.zeros(offset[-1], dtype=np.int64)
    chars[np.delete(np.arange(offset[-1]), offset[:-1])] = sizes
    chars = np.cumsum(chars)
    chars -= np.repeat(chars[offset[:-1]], width)
    shared = np.cumsum(chars[offset[:-1] + np.maximum(lcp, 0)])
    up = np.maximum(depth - 1, 0)
    saved = shared[right] - shared[left] - (count - 1) * chars[offset[left] + up]
    # A leaf's last copy is a conversation that the next one does not continue.
    leaves = np.concatenate(([0], np.cumsum(np.append(lcp[1:], -1) < lengths)))
    # Children begin where neighbours share exactly the node's turns, and at the run's first row.
    branches = np.flatnonzero(lcp < lengths)
    keys = np.sort(lcp[branches] * (n + 1) + branches)
    n_children = (lengths[left] > depth).astype(np.int64)
    n_children += np.searchsorted(keys, depth * (n + 1) + right, side="right")
    n_children -= np.searchsorted(keys, depth * (n + 1) + left, side="right")
    # Conversations that end at a node stand first in its run, by id.
    n_ends = np.where(lengths[left] == depth, _copies(lcp, lengths)[left], 0)

    above, beyond = minima.left_end(left, up), minima.right_end(left + 1, up) - 1
    cut, parent_cut = (left == 0) | (right == n - 1), (above == 0) | (beyond == n - 1)
    # What touches an end of the block is a prefix of its first or last conversation.
    names = prefix_ids(seqs[0], int(lengths[0])), prefix_ids(seqs[-1], int(lengths[-1]))

    def named(mask: np.ndarray, begin: np.ndarray, depth: np.ndarray) -> pa.Array:
        chosen = zip(mask.tolist(), begin.tolist(), depth.tolist())
        return pa.array([names[b > 0][d] if m else None for m, b, d in chosen], pa.binary())

    digests, texts = [], []
    for at, e, c in zip(left.tolist(), n_ends.tolist(), cut.tolist()):
        text = ",".join(map(str, ids[at : at + e].tolist())) if e else None
        texts.append(text if c else None)
        digests.append(None if c else NO_ENDS if text is None else _sha(text))
    m = len(left)
    return _batch(
        {
            "kind": pa.array(np.where(cut, "piece", "node").tolist(), pa.string()),
            "id": named(cut, left, depth),
            "parent_id": named(parent_cut & (depth > 0), above, up),
            "conv_id": pa.array(smallest.minimum(left, right)),
            "depth": pa.array(depth),
            "parent_conv_id": pa.array(
                smallest.minimum(above, beyond), mask=parent_cut | (depth == 0)
            ),
            "n_convs": pa.array(count),
            "n_children": pa.array(n_children),
            "n_leaves": pa.array(leaves[right + 1] - leaves[left]),
            "saved_tokens": pa.array(saved),
            "ends_sha256": pa.array(digests, pa.string()),
            "ends": pa.array(texts, pa.string()),
            "part": pa.array(np.full(m, part, dtype=np.int32)),
            "block": pa.array(np.full(m, block, dtype=np.int64)),
        },
        m,
    )


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _correction(a: bytes, sizes: np.ndarray, b: bytes) -> pa.RecordBatch:
    """What the sum of pieces counts twice at a cut between the neighbours a and b: of each node on
    their common path the child on it, its leaf if b continues a, and characters it saves."""
    shared = common_turns(a, b)
    chars = np.concatenate(([0], np.cumsum(sizes[:shared])))
    depth = np.arange(shared + 1)
    continued = shared == len(a) // WIDTH
    n = shared + 1
    zero = pa.array(np.zeros(n, dtype=np.int64))
    return _batch(
        {
            "kind": pa.array(["piece"] * n),
            "id": pa.array(prefix_ids(a, shared), pa.binary()),
            "depth": pa.array(depth),
            "n_convs": zero,
            "n_children": pa.array(-(depth < shared).astype(np.int64)),
            "n_leaves": pa.array(np.full(n, -1 if continued else 0, dtype=np.int64)),
            "saved_tokens": pa.array(chars[shared] - chars[np.maximum(depth - 1, 0)]),
        },
        n,
    )


def _edge(kind: str, part: int, seq: bytes, sizes: np.ndarray) -> pa.RecordBatch:
    return _batch(
        {
            "kind": pa.array([kind]),
            "part": pa.array([part], pa.int32()),
            "seq": pa.array([seq], pa.binary()),
            "sizes": pa.array([sizes.tolist()], pa.list_(pa.int64())),
        },
        1,
    )


def _sorted_blocks(
    batches: Iterator[pa.RecordBatch], block_turns: int, block_rows: int
) -> Iterator[tuple[np.ndarray, list[bytes], list[np.ndarray]]]:
    ids, seqs, sizes, turns = [], [], [], 0
    for batch in batches:
        bounds = batch.column(2).offsets.to_numpy()
        flat = batch.column(2).values.to_numpy(zero_copy_only=False)
        rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), bounds[:-1], bounds[1:])
        for conv, seq, begin, end in rows:
            if seqs and (len(seqs) == block_rows or turns + len(seq) // WIDTH > block_turns):
                yield np.array(ids, dtype=np.int64), seqs, sizes
                ids, seqs, sizes, turns = [], [], [], 0
            ids.append(conv)
            seqs.append(seq)
            sizes.append(flat[begin:end].copy())
            turns += len(seq) // WIDTH
    if seqs:
        yield np.array(ids, dtype=np.int64), seqs, sizes


def _task(
    batches: Iterator[pa.RecordBatch], block_turns: int, block_rows: int
) -> Iterator[pa.RecordBatch]:
    """Nodes and pieces of the task's blocks, corrections at its inner cuts, and its two ends."""
    part = TaskContext.get().partitionId()
    before: tuple[bytes, np.ndarray] | None = None
    for block, (ids, seqs, sizes) in enumerate(_sorted_blocks(batches, block_turns, block_rows)):
        if before is None:
            yield _edge("first", part, seqs[0], sizes[0])
        else:
            yield _correction(*before, seqs[0])
        yield _nodes(ids, seqs, np.concatenate(sizes), part, block)
        before = seqs[-1], sizes[-1]
    if before is not None:
        yield _edge("last", part, *before)


def _cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, sizes, b in zip(*(c.to_pylist() for c in batch.columns)):
            yield _correction(a, np.array(sizes, dtype=np.int64), b)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's ids from its pieces in order; one piece is held at a time."""

    def out(node: bytes, seen) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"id": [node], "ends_sha256": [seen.hexdigest()]})

    node, seen = None, None
    for batch in batches:
        for own, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if own == node:
                seen.update(b",")
            else:
                if node is not None:
                    yield out(node, seen)
                node, seen = own, hashlib.sha256()
            seen.update(text.as_py().encode())
    if node is not None:
        yield out(node, seen)


def trie(
    convs: DataFrame, block_turns: int = BLOCK_TURNS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """One row per different sequence of first turns of (conv_id, turns), as ``sequences`` and
    ``rebuilt`` give them:

    conv_id (the smallest member), depth, parent_conv_id (null for the root), n_convs, n_children,
    n_leaves (childless nodes of the subtree), saved_tokens (the subtree's sum of n_convs - 1 times
    the characters of a node's last turn), ends_sha256 (of the ids that end here, ascending).

    Each row of ``convs`` is a member, so ids should be unique, as in both. Turnless conversations
    end at the root. No conversations give no nodes. Equal turns are equal 128-bit hashes of role
    and text. A task holds one block; of one conversation it holds 24 bytes a turn, without texts.
    """
    spark = convs.sparkSession
    hexed = F.array_join(F.transform("turns", lambda t: F.hex(t["key"])), "")
    rows = convs.select("conv_id", F.unhex(hexed).alias("seq"), F.col("turns.size").alias("sizes"))
    ordered = rows.repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    found = stage(
        ordered.mapInArrow(lambda batches: _task(batches, block_turns, block_rows), SCHEMA), "trie"
    )
    pieces = found.filter(F.col("kind") == "piece")
    ends = {k: found.filter(F.col("kind") == k).select("part", "seq", "sizes") for k in ("first", "last")}
    # One number per task; neighbours are the next tasks that had rows.
    parts = sorted(r["part"] for r in ends["first"].select("part").collect())
    if len(parts) > 1:
        after = spark.createDataFrame(list(zip(parts, parts[1:])), "part int, next int")
        begins = ends["first"].select(F.col("part").alias("next"), F.col("seq").alias("b"))
        beside = ends["last"].join(after, "part").join(begins, "next").select("seq", "sizes", "b")
        pieces = pieces.unionByName(beside.mapInArrow(_cuts, SCHEMA))
    merged = stage(
        pieces.groupBy("id").agg(
            F.max("depth").alias("depth"),
            F.max("parent_id").alias("parent_id"),
            F.min("conv_id").alias("conv_id"),
            *(
                F.sum(c).alias(c)
                for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")
            ),
        ),
        "cut-nodes",
    )
    digests = (
        found.filter((F.col("kind") == "piece") & F.col("ends").isNotNull())
        .select("id", "ends", "part", "block")
        .repartition("id")
        .sortWithinPartitions("id", "part", "block")
        .select("id", "ends")
        .mapInArrow(_chained, "id binary, ends_sha256 string")
    )
    whole = (
        merged.join(digests, "id", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))
        .withColumn("parent_conv_id", F.lit(None).cast("long"))
        .select("parent_id", *COLUMNS)
    )
    inside = found.filter(F.col("kind") == "node").select("parent_id", *COLUMNS)
    parents = merged.select(F.col("id").alias("parent_id"), F.col("conv_id").alias("parent"))
    open_ = inside.filter(F.col("parent_id").isNotNull()).unionByName(whole)
    named = open_.join(parents, "parent_id", "left").withColumn("parent_conv_id", F.col("parent"))
    return inside.filter(F.col("parent_id").isNull()).select(*COLUMNS).unionByName(named.select(*COLUMNS))
