"""Language-model scores from a weighted backoff automaton over word n-grams.

Unigram probabilities are add-half estimates over all training words. Longer n-grams are discounted
counts; what the discount leaves goes to the next shorter history, as a weight on a failure arc.
States are histories. A text is read from left to right: an arc of the current state is taken if the
word has one, else the failure arc adds its weight and leads to the shorter history, down to the
root, where every word has its unigram probability. As an automaton of order n forgets all but n - 1
words, the state before a token is the longest kept n-gram that ends there; so the states of all
tokens of a slice of texts are found at once, and then arcs taken and failure weights are added up.

All words, and all n-grams that occur ``LEAST`` times, are kept, so the model grows with the corpus
and is nowhere whole. Texts are stored once, as numbered tokens in slices of bounded size, and a slice
builds the part of the automaton that its own texts can reach. What it does not know itself it asks,
in two rounds of messages between slices and hash ranges of n-grams:

1. a slice sends each of its different n-grams with its count once; the range adds up and answers with
   the totals, in the order of the question, and names one of the slices that asked the owner. The
   longest n-grams go in a message round of their own, so not all are on the way at once;
2. the owners of kept n-grams add their discounted counts to their history, and all slices ask for the
   sums of their states; the range adds up and answers, and failure weights come from the sums. They
   are whole numbers, so nothing depends on the order of addition.

Messages are packed arrays, so an n-gram costs some six bytes a slice instead of a row, and an answer
about one. No n-gram that a slice meets goes through a join.

Words are identified by 64-bit hashes.
"""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payrisk.llm.text import NOT_SPACE, Words, chain, row_slices, row_sums
from payrisk.session import stage

ORDER = 3
#: Share of all training tokens that words in n-grams, and n-grams, must have: none is asked for.
WORD_SHARE = 0.0
NGRAM_SHARE = 0.0
#: N-grams are kept from this count on, at any size of the corpus.
LEAST = 2
DISCOUNT = 0.5
#: Text bytes of a slice, but one text at least.
SLICE_BYTES = 12 << 20
#: N-grams that a hash range should get from all slices.
RANGE_KEYS = 2_000_000
#: Seconds that Python gets to let go of the plans of a round.
SETTLE_S = 1.0
#: Stands for the end of a text; no word has it but by a collision of 64-bit hashes.
END = np.uint64(0x9AE16A3B2F90404F)

TOKENS = (
    "slice bigint, ids array<bigint>, held array<boolean>, bounds binary, codes binary,"
    " vocabulary binary, n_train bigint"
)
MESSAGE = "bucket bigint, slice bigint, depth int, keys binary, a binary, b binary"
ANSWER = "slice bigint, bucket bigint, depth int, answer binary, n_distinct bigint"
SCORED = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double"
)


def pack(values: np.ndarray) -> bytes:
    """Compressed array; the bytes of equal significance stand together, as they repeat most."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize)
    return zstandard.ZstdCompressor(level=1).compress(raw.T.tobytes())


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as their differences, whose first bytes are nearly all zero."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob, np.uint64), dtype=np.uint64)


def unpack(blob: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of the rows, ends included, and the row bounds in them."""
    words = Words(column, NOT_SPACE)
    bounds = words.rows + np.arange(len(words.rows))
    out = np.empty(bounds[-1], dtype=np.uint64)
    ends = bounds[1:] - 1
    plain = np.ones(len(out), dtype=bool)
    plain[ends] = False
    out[ends] = END
    out[plain] = words.hashes()
    return out, bounds


def _inside(n: int, bounds: np.ndarray) -> np.ndarray:
    inside = np.ones(n, dtype=bool)
    inside[bounds[:-1][bounds[:-1] < n]] = False
    return inside


def _grams(
    hashes: np.ndarray, bounds: np.ndarray, order: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per order from 2 on: keys of the n-grams, of their histories and of their suffixes, and the
    places they end at."""
    inside = _inside(len(hashes), bounds)
    keys, here = hashes, np.ones(len(hashes), dtype=bool)
    for _ in range(1, order):
        here = inside & np.concatenate(([False], here[:-1]))
        at = np.flatnonzero(here)
        history, suffix = keys[at - 1], keys[at]
        keys = keys.copy()
        keys[at] = chain(history, suffix)
        yield keys[at], history, suffix, at


def _slices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for a, b in row_slices(batch.column(2), size):
            hashes, bounds = _tokens(batch.column(2).slice(a, b - a))
            held = batch.column(1).slice(a, b - a)
            vocabulary, codes = np.unique(hashes, return_inverse=True)
            free = ~held.to_numpy(zero_copy_only=False).astype(bool)
            yield pa.RecordBatch.from_pydict(
                {
                    "slice": pa.array([number], pa.int64()),
                    "ids": pa.array([batch.column(0).slice(a, b - a).to_pylist()], pa.list_(pa.int64())),
                    "held": pa.array([held.to_pylist()], pa.list_(pa.bool_())),
                    "bounds": pa.array([pack(bounds.astype(np.int64))], pa.binary()),
                    "codes": pa.array([pack(codes.astype(np.uint32))], pa.binary()),
                    "vocabulary": pa.array([pack_keys(vocabulary)], pa.binary()),
                    "n_train": pa.array([int(np.diff(bounds)[free].sum())], pa.int64()),
                }
            )
            number += 1


@dataclass
class Level:
    """The n-grams of one length in a slice. ``keys`` are the different ones, ascending; ``of`` is
    the place there of the n-gram that ends at a token, -1 where none does; ``first`` is a token
    that each one ends at."""

    keys: np.ndarray
    of: np.ndarray
    first: np.ndarray


class Slice:
    """Tokens of some texts and their n-grams."""

    def __init__(self, row: dict, order: int, depths: Sequence[int] | None = None):
        """Only the levels of ``depths`` are made, if given; depth 0 are words."""
        self.ids, self.held = row["ids"], row["held"]
        self.bounds = unpack(row["bounds"], np.int64)
        hashes = unpack_keys(row["vocabulary"])[unpack(row["codes"], np.uint32)]
        n = len(hashes)
        wanted = range(order) if depths is None else depths
        self.levels = {}
        if 0 in wanted:
            self.levels[0] = self._level(hashes, np.arange(n), n)
        for depth, (keys, _, _, at) in enumerate(_grams(hashes, self.bounds, max(wanted) + 1), 1):
            if depth in wanted:
                self.levels[depth] = self._level(keys, at, n)

    @staticmethod
    def _level(keys: np.ndarray, at: np.ndarray, n: int) -> Level:
        # Places in a slice take four bytes: the arrays of two tasks share an executor.
        order = np.argsort(keys).astype(np.int32)
        ranked = keys[order]
        new = np.ones(len(ranked), dtype=bool)
        new[1:] = ranked[1:] != ranked[:-1]
        at = at.astype(np.int32)[order]
        of = np.full(n, -1, dtype=np.int32)
        of[at] = np.cumsum(new, dtype=np.int32) - 1
        return Level(ranked[new], of, at[new])

    def train_counts(self, level: Level) -> np.ndarray:
        """How often each n-gram of the level stands in training texts."""
        free = np.repeat(~np.array(self.held, dtype=bool), np.diff(self.bounds))
        return np.bincount(level.of[free & (level.of >= 0)], minlength=len(level.keys))


def _rows(table) -> Iterator[dict]:
    for row in range(table.num_rows):
        yield {name: table.column(name)[row].as_py() for name in table.schema.names}


def _cuts(keys: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(bucket, begin, end) of the keys of each hash range that has some."""
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
    begins = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = np.append(begins[1:], len(keys))
    return list(zip(bucket[begins].tolist(), begins.tolist(), ends.tolist()))


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [part.split() for part in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)],
        names=[name for name, _ in fields],
    )


def _questions(
    batches: Iterator[pa.RecordBatch], depths: Sequence[int], bits: int
) -> Iterator[pa.RecordBatch]:
    """First round: the different n-grams of each slice, of some depths, and their counts in
    training texts."""
    for batch in batches:
        for row in _rows(batch):
            own = Slice(row, max(depths) + 1, depths)
            for depth, level in own.levels.items():
                counts = own.train_counts(level).astype(np.uint32)
                yield _table(
                    [
                        (b, row["slice"], depth, pack_keys(level.keys[s:e]), pack(counts[s:e]), None)
                        for b, s, e in _cuts(level.keys, bits)
                    ],
                    MESSAGE,
                )


def _by_depth(table: pa.Table) -> Iterator[tuple[int, list[dict], np.ndarray, np.ndarray, np.ndarray]]:
    """Per length of n-grams: the messages of a range in order, the place of each of their keys in
    key order, where a new key begins there, and the bounds of the messages."""
    for depth in sorted(set(table.column("depth").to_pylist())):
        part = table.filter(pc.equal(table.column("depth"), depth)).sort_by("slice")
        messages = list(_rows(part))
        keys = [unpack_keys(m["keys"]) for m in messages]
        bounds = np.concatenate(([0], np.cumsum([len(k) for k in keys])))
        keys = np.concatenate(keys)
        ranked = np.argsort(keys, kind="stable")
        sorted_keys = keys[ranked]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = sorted_keys[1:] != sorted_keys[:-1]
        yield depth, messages, ranked, np.flatnonzero(new), bounds


def _totals(table: pa.Table) -> pa.Table:
    """Answers of one range: twice the total of each n-gram, and 1 more for the slice that owns it."""
    out = []
    for depth, messages, ranked, starts, bounds in _by_depth(table):
        counts = np.concatenate([unpack(m["a"], np.uint32) for m in messages]).astype(np.int64)
        totals = np.add.reduceat(counts[ranked], starts)
        answer = np.empty(len(ranked), dtype=np.uint64)
        answer[ranked] = 2 * np.repeat(totals, np.diff(np.append(starts, len(ranked))))
        known = answer[ranked[starts]] > 0
        answer[ranked[starts]] += np.uint64(1)
        owned = np.zeros(len(ranked), dtype=bool)
        owned[ranked[starts[known]]] = True
        for m, s, e in zip(messages, bounds, bounds[1:]):
            out.append((m["slice"], m["bucket"], depth, pack(answer[s:e]), int(owned[s:e].sum())))
    return pa.Table.from_batches([_table(out, ANSWER)])


def _sums(table: pa.Table) -> pa.Table:
    """Answers of one range: for each state both sums over its kept followers."""
    out = []
    for depth, messages, ranked, starts, bounds in _by_depth(table):
        answers = []
        for part in ("a", "b"):
            values = np.concatenate([unpack(m[part], np.int64) for m in messages])
            totals = np.add.reduceat(values[ranked], starts)
            answer = np.empty(len(ranked), dtype=np.int64)
            answer[ranked] = np.repeat(totals, np.diff(np.append(starts, len(ranked))))
            answers.append(answer)
        for m, s, e in zip(messages, bounds, bounds[1:]):
            both = pack(np.concatenate([answer[s:e] for answer in answers]))
            out.append((m["slice"], m["bucket"], depth, both, 0))
    return pa.Table.from_batches([_table(out, ANSWER)])


@dataclass
class Sizes:
    """What all slices know of the corpus: training tokens and different words, and the parameters."""

    total: int
    distinct: int
    order: int
    word_share: float
    ngram_share: float

    @property
    def size(self) -> float:
        return self.total + 0.5 * (self.distinct + 1)


def _answers(table: pa.Table, depth: int, kind: type, parts: int = 1) -> list[np.ndarray]:
    """The ranges' answers for the n-grams of a depth on end, for each part of an answer."""
    part = table.filter(pc.equal(table.column("depth"), depth)).sort_by("bucket")
    blobs = [np.split(unpack(x, kind), parts) for x in part.column("answer").to_pylist()]
    return [np.concatenate([b[k] for b in blobs]) if blobs else np.empty(0, kind) for k in range(parts)]


class Arcs:
    """The part of the automaton that a slice can reach: of each n-gram of the slice its count,
    whether it is kept, and the probability on its arc."""

    def __init__(self, own: Slice, totals: pa.Table, sizes: Sizes):
        least = max(sizes.total * sizes.ngram_share, LEAST)
        self.counts, self.owned, self.kept, self.chance = [], [], [], []
        #: Per n-gram the place of its history and of its suffix one level below.
        self.history, self.suffix = [], []
        for depth, level in own.levels.items():
            (answer,) = _answers(totals, depth, np.uint64)
            if len(answer) != len(level.keys):
                raise RuntimeError("answers of a round are missing")
            counts = (answer >> np.uint64(1)).astype(np.float64)
            self.counts.append(counts)
            self.owned.append((answer & np.uint64(1)) > 0)
            if depth == 0:
                self.history.append(None)
                self.suffix.append(None)
                self.kept.append(counts >= max(sizes.total * sizes.word_share, 1))
                self.chance.append((counts + 0.5) / sizes.size)
                continue
            below = own.levels[depth - 1]
            history, suffix = below.of[level.first - 1], below.of[level.first]
            kept = counts >= least
            kept &= self.kept[-1][history] & self.kept[-1][suffix]
            self.history.append(history)
            self.suffix.append(suffix)
            self.kept.append(kept)
            with np.errstate(divide="ignore", invalid="ignore"):
                self.chance.append(np.where(kept, (counts - DISCOUNT) / self.counts[-2][history], 0.0))

    def states(self, depth: int) -> np.ndarray:
        """The n-grams that can have kept followers: none that was seen once can."""
        return np.flatnonzero(self.kept[depth] & (self.counts[depth] >= LEAST))


def _twice(counts: np.ndarray, depth: int) -> np.ndarray:
    """Twice the counts that probabilities are made of: whole numbers."""
    return 2 * counts + 1 if depth == 0 else 2 * counts - 2 * DISCOUNT


def _contributions(left: pa.Table, right: pa.Table, sizes: Sizes, bits: int) -> pa.Table:
    """Second round: the states of a slice, with the sums over their followers that the slice owns:
    of the followers' counts, and of those of the followers' suffixes."""
    out = []
    for row in _rows(left):
        own = Slice(row, sizes.order)
        arcs = Arcs(own, right, sizes)
        for depth in range(sizes.order - 1):
            mine = np.flatnonzero(arcs.kept[depth + 1] & arcs.owned[depth + 1])
            history, suffix = arcs.history[depth + 1][mine], arcs.suffix[depth + 1][mine]
            n = len(own.levels[depth].keys)
            states = arcs.states(depth)
            taken = np.bincount(history, _twice(arcs.counts[depth + 1][mine], depth + 1), n)[states]
            given = np.bincount(history, _twice(arcs.counts[depth][suffix], depth), n)[states]
            taken, given = taken.astype(np.int64), given.astype(np.int64)
            keys = own.levels[depth].keys[states]
            out += [
                (b, row["slice"], depth, pack_keys(keys[s:e]), pack(taken[s:e]), pack(given[s:e]))
                for b, s, e in _cuts(keys, bits)
            ]
    return pa.Table.from_batches([_table(out, MESSAGE)])


def _failure_weights(arcs: Arcs, sums: pa.Table, depth: int, sizes: Sizes) -> np.ndarray:
    """Per n-gram of a depth the weight of its failure arc: what its arcs leave, over what the arcs
    to the same words would leave at the shorter history. 0 without arcs."""
    states = arcs.states(depth)
    taken, given = _answers(sums, depth, np.int64, 2)
    if len(taken) != len(states):
        raise RuntimeError("answers of a round are missing")
    of = arcs.counts[depth][states]
    below = sizes.size if depth == 0 else arcs.counts[depth - 1][arcs.suffix[depth][states]]
    left = np.maximum(1 - taken / 2 / of, 1e-12)
    rest = np.maximum(1 - given / 2 / below, 1e-12)
    weight = np.zeros(len(arcs.counts[depth]))
    weight[states] = np.where(taken > 0, np.log10(left / rest), 0.0)
    return weight


def _walk(own: Slice, arcs: Arcs, sums: pa.Table, sizes: Sizes) -> np.ndarray:
    """Log10 probability of each token, all texts of the slice being read from left to right.

    From the state of the longest history that is kept a token takes its arc, or fails to the next
    shorter one, which adds the state's weight, until an arc is there; the root has all words."""
    score = np.log10(arcs.chance[0])[own.levels[0].of]
    for depth in range(1, sizes.order):
        level, below = own.levels[depth], own.levels[depth - 1]
        weight = _failure_weights(arcs, sums, depth - 1, sizes)
        at = np.flatnonzero(level.of >= 0)
        state, gram = below.of[at - 1], level.of[at]
        live = arcs.kept[depth - 1][state]
        at, state, gram = at[live], state[live], gram[live]
        with np.errstate(divide="ignore"):
            arc = np.log10(arcs.chance[depth][gram])
        score[at] = np.where(arcs.kept[depth][gram], arc, weight[state] + score[at])
    return score


def _scores(left: pa.Table, right: pa.Table, sizes: Sizes) -> pa.Table:
    """Scores of a slice's texts from the answers of both rounds."""
    first = right.filter(pc.equal(right.column("round"), 1))
    second = right.filter(pc.equal(right.column("round"), 2))
    out = []
    for row in _rows(left):
        own = Slice(row, sizes.order)
        arcs = Arcs(own, first, sizes)
        words = own.levels[0].of
        base = np.log10(arcs.chance[0])[words]
        known = (arcs.counts[0] > 0)[words].astype(np.int64)
        out.append(
            pa.RecordBatch.from_arrays(
                [
                    pa.array(own.ids, pa.int64()),
                    pa.array(own.held, pa.bool_()),
                    pa.array(np.diff(own.bounds)),
                    pa.array(row_sums(known, own.bounds)),
                    pa.array(row_sums(base, own.bounds)),
                    pa.array(row_sums(_walk(own, arcs, second, sizes), own.bounds)),
                ],
                names=[part.split()[0] for part in SCORED.split(", ")],
            )
        )
    return pa.Table.from_batches(out)


def _settle(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished rounds: it acts when the driver
    collects the plans they belong to. Python tells the JVM from a thread of its own that it has let
    go of a plan, and what the plan held goes with the collection after that: so twice, with a
    moment for it."""
    for _ in range(2):
        gc.collect()
        time.sleep(SETTLE_S)
        spark.sparkContext._jvm.System.gc()


def score(
    docs: DataFrame,
    held_out: Column,
    id_column: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    word_share: float = WORD_SHARE,
    ngram_share: float = NGRAM_SHARE,
    slice_bytes: int = SLICE_BYTES,
    range_keys: int = RANGE_KEYS,
) -> DataFrame:
    """Train on the rows where ``held_out`` is not true and score all rows: doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score, score.

    Null and empty texts are one token, their end. ``held_out`` counts as false where it is null.
    Rows that repeat each count and each keep a row. Scores do not depend on ``slice_bytes`` and
    ``range_keys``, which bound what a task holds.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col(text).alias("text"),
    )
    tokens = stage(rows.mapInArrow(lambda batches: _slices(batches, slice_bytes), TOKENS), "tokens")
    seen = tokens.agg(
        F.sum("n_train").alias("total"), F.sum(F.length("codes")).alias("packed")
    ).first()
    total = seen["total"] or 0
    # A packed token takes two bytes or less; ranges are a power of two.
    ranges = max(2, order * (seen["packed"] or 0) // range_keys)
    bits = max(1, (ranges - 1).bit_length())
    totals = None
    for depths in (range(min(2, order)), *((d,) for d in range(2, order))):
        answered = stage(
            tokens.mapInArrow(lambda batches, d=depths: _questions(batches, d, bits), MESSAGE)
            .groupBy("bucket")
            .applyInArrow(_totals, ANSWER),
            "totals",
        )
        totals = answered if totals is None else totals.unionByName(answered)
        _settle(spark)
    distinct = totals.filter("depth = 0").agg(F.sum("n_distinct").alias("n")).first()["n"] or 0
    sizes = Sizes(total, distinct, order, word_share, ngram_share)
    asked = (
        tokens.groupBy("slice")
        .cogroup(totals.groupBy("slice"))
        .applyInArrow(lambda a, b: _contributions(a, b, sizes, bits), MESSAGE)
    )
    sums = stage(asked.groupBy("bucket").applyInArrow(_sums, ANSWER), "follower-sums")
    del asked
    _settle(spark)
    answers = totals.withColumn("round", F.lit(1)).unionByName(sums.withColumn("round", F.lit(2)))
    scored = (
        tokens.groupBy("slice")
        .cogroup(answers.groupBy("slice"))
        .applyInArrow(lambda a, b: _scores(a, b, sizes), SCORED)
    )
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
    )
