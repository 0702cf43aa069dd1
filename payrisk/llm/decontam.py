"""Benchmark decontamination over a distributed positional inverted index.

The index is cut by document into segments, as search engines do: a segment holds the postings of
all words of some whole documents, so no word's list, however common, ever meets in one place, and
building it needs no shuffle. A segment is one row: its sorted word hashes, their list lengths, and
the gaps between ascending word positions (counted over the segment's documents in turn).

Test items come in blocks of bounded size. In each segment a phrase starts from the list of its
rarest word; the lists of its other words, rarest first, are moved by their offsets and intersected.
Words are compared by 64-bit hashes; a false match would need all words of a window to collide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payrisk.llm.text import ALNUM, Words, row_slices
from payrisk.session import scratch_path, stage

WINDOW = 10
#: Text bytes of the documents of one segment (a longer document is a segment of its own).
SEGMENT_BYTES = 4 << 20
#: Characters of test items that are matched in one pass over the index.
BLOCK_CHARS = 8_000_000

INDEX = T.StructType(
    [
        T.StructField("segment", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("n_words", T.ArrayType(T.LongType())),
        T.StructField("terms", T.BinaryType()),
        T.StructField("counts", T.BinaryType()),
        T.StructField("gaps", T.BinaryType()),
    ]
)
HITS = T.StructType(
    [
        T.StructField("segment", T.LongType()),
        T.StructField("place", T.IntegerType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def _segment(ids: pa.Array, column: pa.Array, number: int) -> pa.RecordBatch:
    words = Words(column, ALNUM)
    hashes = words.hashes()
    order = np.argsort(hashes, kind="stable").astype(np.uint32)
    ranked = hashes[order]
    first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1]))[: len(ranked)])
    counts = np.diff(np.append(first, len(ranked))).astype(np.uint32)
    gaps = order.copy()
    gaps[1:] -= order[:-1]
    gaps[first] = order[first]
    values = [
        pa.array([number], pa.int64()),
        pa.array([ids.to_pylist()], pa.list_(pa.int64())),
        pa.array([words.per_row], pa.list_(pa.int64())),
        *(pa.array([x.tobytes()], pa.binary()) for x in (ranked[first], counts, gaps)),
    ]
    return pa.RecordBatch.from_arrays(values, names=INDEX.names)


def build_index(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    segment_bytes: int = SEGMENT_BYTES,
) -> DataFrame:
    """Store the postings of every word of ``docs`` and return the index, one row per segment.

    Null and empty texts have no words. Null ids and repeated rows are kept as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for a, b in row_slices(batch.column(1), segment_bytes):
                yield _segment(
                    batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), number
                )
                number += 1

    index = docs.select(F.col(id_column).cast("long"), F.col(text)).mapInArrow(run, INDEX)
    path = scratch_path(docs.sparkSession, "postings")
    index.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(INDEX).parquet(path)


@dataclass
class Segment:
    """Postings of one segment, decoded."""

    terms: np.ndarray
    ends: np.ndarray
    keys: np.ndarray  # word number << 32 | position, ascending
    doc_ends: np.ndarray

    @classmethod
    def read(cls, row: dict) -> Segment:
        terms = np.frombuffer(row["terms"], np.uint64)
        counts = np.frombuffer(row["counts"], np.uint32).astype(np.int64)
        gaps = np.frombuffer(row["gaps"], np.uint32).astype(np.int64)
        ends = np.cumsum(counts)
        total = np.cumsum(gaps)
        before = np.where(ends - counts > 0, total[ends - counts - 1], 0) if len(ends) else ends
        places = total - np.repeat(before, counts)
        keys = np.repeat(np.arange(len(terms), dtype=np.int64) << 32, counts) | places
        return cls(terms, ends, keys, np.cumsum(np.asarray(row["n_words"], dtype=np.int64)))

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word, -1 if the segment has none of it."""
        if not len(self.terms):
            return np.full(hashes.shape, -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)

    def frequency(self, number: np.ndarray) -> np.ndarray:
        starts = np.where(number > 0, self.ends[number - 1], 0)
        return np.where(number < 0, 0, self.ends[number] - starts)

    def holds(self, number: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Whether word ``number`` stands at ``place``."""
        key = number << 32 | place
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return (self.keys[at] == key) & (place >= 0)

    def postings(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of several words on end, and for each place which of the words it is of."""
        count = self.frequency(number)
        owner = np.repeat(np.arange(len(number)), count)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        start = np.where(number > 0, self.ends[number - 1], 0)
        return self.keys[start[owner] + step] & 0xFFFFFFFF, owner

    def doc_of(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_ends, place, side="right")


#: The owner of windows of rows without an item id.
NOBODY = -1


@dataclass
class Block:
    """Windows of some test items: word hashes (rows padded), lengths, and the item of each."""

    windows: np.ndarray
    lengths: np.ndarray
    owner: np.ndarray
    items: list[str]


def item_blocks(
    items: DataFrame, id_column: str, text: str, window: int, block_chars: int = BLOCK_CHARS
) -> Iterator[Block]:
    """Blocks of the items' distinct windows. Items are fetched partition by partition; the driver
    holds one block of about ``block_chars`` characters at a time. Items without words have no
    windows; rows of the same id make one item. Rows without an id are no item that could be named,
    but their windows hit all the same."""
    rows, size = [], 0
    chosen = items.select(F.col(id_column).cast("string").alias("i"), F.col(text).alias("t"))
    for row in chosen.filter("t is not null").toLocalIterator():
        rows.append((row["i"], row["t"]))
        size += len(row["t"])
        if size >= block_chars:
            yield _block(rows, window)
            rows, size = [], 0
    if rows:
        yield _block(rows, window)


def _block(rows: list[tuple[str, str]], window: int) -> Block:
    words = Words(pa.array([t for _, t in rows], pa.string()), ALNUM)
    hashes = words.hashes()
    names = sorted({i for i, _ in rows if i is not None})
    number = {name: k for k, name in enumerate(names)} | {None: NOBODY}
    made: dict[tuple, None] = {}
    for k, (name, _) in enumerate(rows):
        own = hashes[words.rows[k] : words.rows[k + 1]].tolist()
        for at in range(max(1, len(own) - window + 1) if own else 0):
            made[(number[name], *own[at : at + window])] = None
    windows = np.zeros((len(made), window), dtype=np.uint64)
    lengths = np.empty(len(made), dtype=np.int64)
    for k, (_, *own) in enumerate(made):
        windows[k, : len(own)] = own
        lengths[k] = len(own)
    owner = np.array([key[0] for key in made], dtype=np.int64)
    return Block(windows, lengths, owner, names)


def phrase_starts(seg: Segment, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(place, window number) of every exact occurrence of a window in the segment."""
    offsets = np.arange(block.windows.shape[1])
    used = offsets[None, :] < block.lengths[:, None]
    number = np.where(used, seg.lookup(block.windows), -1)
    alive = np.flatnonzero(((number >= 0) | ~used).all(axis=1))
    if not len(alive):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    number, used = number[alive], used[alive]
    frequency = np.where(used, seg.frequency(number), np.iinfo(np.int64).max)
    by_rarity = np.argsort(frequency, axis=1, kind="stable")
    rows = np.arange(len(alive))
    place, owner = seg.postings(number[rows, by_rarity[:, 0]])
    place = place - by_rarity[owner, 0]
    for rank in range(1, by_rarity.shape[1]):
        offset = by_rarity[owner, rank]
        last = ~used[owner, offset]
        ok = last | seg.holds(np.maximum(number[owner, offset], 0), place + offset)
        place, owner = place[ok], owner[ok]
    length = block.lengths[alive][owner]
    ok = (place >= 0) & (seg.doc_of(place) == seg.doc_of(place + length - 1))
    return place[ok], alive[owner[ok]]


def near_spans(
    seg: Segment, block: Block, slop: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, end, window number) of the narrowest runs of ``length + slop`` words at most that
    hold all words of a window, in any order and as often as the window has them.

    Searched around each occurrence of the window's rarest word: only runs that hold it can match.
    """
    offsets = np.arange(block.windows.shape[1])
    used = offsets[None, :] < block.lengths[:, None]
    number = np.where(used, seg.lookup(block.windows), -1)
    alive = np.flatnonzero(((number >= 0) | ~used).all(axis=1))
    found: set[tuple[int, int, int]] = set()
    for k in alive.tolist():
        span = int(block.lengths[k]) + slop
        terms, needed = np.unique(number[k][used[k]], return_counts=True)
        lists = [seg.postings(np.array([t]))[0] for t in terms]
        for anchor in min(lists, key=len).tolist():
            doc = seg.doc_of(np.array([anchor]))[0]
            low = max(anchor - span + 1, int(seg.doc_ends[doc - 1]) if doc else 0)
            high = min(anchor + span, int(seg.doc_ends[doc]))
            near = [x[np.searchsorted(x, low) : np.searchsorted(x, high)] for x in lists]
            if any(len(x) < n for x, n in zip(near, needed)):
                continue
            found.update((a, b + 1, k) for a, b in _narrowest(near, needed.tolist(), anchor, span))
    out = np.array(sorted(found), dtype=np.int64).reshape(-1, 3)
    return out[:, 0], out[:, 1], out[:, 2]


def _narrowest(
    near: list[np.ndarray], needed: list[int], anchor: int, span: int
) -> Iterator[tuple[int, int]]:
    """(first, last) places of the runs around ``anchor`` that cannot lose either end."""
    events = sorted((int(p), j) for j, x in enumerate(near) for p in x)
    have, missing, left = [0] * len(near), sum(needed), 0
    for p, j in events:
        have[j] += 1
        missing -= have[j] <= needed[j]
        while have[events[left][1]] > needed[events[left][1]]:
            have[events[left][1]] -= 1
            left += 1
        first = events[left][0]
        if not missing and have[j] == needed[j] and p - first < span and first <= anchor <= p:
            yield first, p


def _merged(starts: np.ndarray, ends: np.ndarray) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted(zip(starts.tolist(), ends.tolist())):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def _match(batches: Iterator[pa.RecordBatch], block: Block, slop: int | None):
    for batch in batches:
        for k in range(batch.num_rows):
            row = {name: batch.column(name)[k].as_py() for name in INDEX.names if name != "doc_ids"}
            seg = Segment.read(row)
            if slop is None:
                place, which = phrase_starts(seg, block)
                reach = block.lengths[which]
            else:
                place, end, which = near_spans(seg, block, slop)
                reach = end - place
            doc = seg.doc_of(place)
            order = np.argsort(doc, kind="stable")
            place, which, reach, doc = place[order], which[order], reach[order], doc[order]
            docs, first = np.unique(doc, return_index=True)
            ends = np.append(first[1:], len(doc))
            base = np.concatenate(([0], seg.doc_ends))
            out = {"segment": [], "place": [], "spans": [], "items": []}
            for d, a, b in zip(docs.tolist(), first.tolist(), ends.tolist()):
                start = place[a:b] - base[d]
                stop = np.minimum(start + reach[a:b], base[d + 1] - base[d])
                out["segment"].append(row["segment"])
                out["place"].append(d)
                out["spans"].append(_merged(start, stop))
                owners = np.unique(block.owner[which[a:b]])
                out["items"].append([block.items[i] for i in owners[owners != NOBODY]])
            yield pa.RecordBatch.from_pydict(
                out,
                schema=pa.schema(
                    [
                        ("segment", pa.int64()),
                        ("place", pa.int32()),
                        ("spans", pa.list_(pa.list_(pa.int64()))),
                        ("items", pa.list_(pa.string())),
                    ]
                ),
            )


def find_items(
    index: DataFrame,
    items: DataFrame,
    id_column: str = "item_id",
    text: str = "text",
    window: int = WINDOW,
    slop: int | None = None,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per indexed document: doc_id, n_words, n_hit, items (sorted ids as strings), spans.

    A window is ``window`` consecutive item words, or a whole shorter item. Without ``slop`` it has
    to occur exactly; with it, its words have to stand in any order, each as often as the window has
    it, within that many words more.
    ``spans`` are the merged [start, end) word ranges that windows cover, n_hit their total length.
    """
    hits = None
    for block in item_blocks(items, id_column, text, window, block_chars):
        found = index.drop("doc_ids").mapInArrow(
            lambda batches, block=block: _match(batches, block, slop), HITS
        )
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        hits = index.sparkSession.createDataFrame([], HITS)
    # Few documents have hits; a document has one row per block of items.
    merged = (
        stage(hits, "hits")
        .groupBy("segment", "place")
        .agg(
            F.array_sort(F.flatten(F.collect_list("spans"))).alias("pieces"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
        .withColumn(
            "spans",
            F.expr(
                """aggregate(pieces, cast(array() as array<array<bigint>>), (done, x) ->
                    if(size(done) > 0 and element_at(done, -1)[1] >= x[0],
                       concat(slice(done, 1, size(done) - 1),
                              array(array(element_at(done, -1)[0],
                                          greatest(element_at(done, -1)[1], x[1])))),
                       concat(done, array(x))))"""
            ),
        )
        .drop("pieces")
    )
    docs = index.select(
        "segment", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("place", "d")
    ).select("segment", "place", "d.doc_ids", "d.n_words")
    none = F.expr("cast(array() as array<array<bigint>>)")
    return docs.join(merged, ["segment", "place"], "left").select(
        F.col("doc_ids").alias("doc_id"),
        "n_words",
        F.expr("aggregate(coalesce(spans, array()), 0L, (n, x) -> n + x[1] - x[0])").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", none).alias("spans"),
    )


def contaminated(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """Index ``docs`` (doc_id, text) and find the windows of ``items`` (item_id, text) in them."""
    return find_items(build_index(docs), items, window=window, block_chars=block_chars)


def keep_clean(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """The rows of ``docs``, columns unchanged, in whose text no window of ``items`` occurs.

    Rows are told apart by id and text, so an id that several texts share loses only those hit."""
    key = F.struct(F.col(id_column).cast("string").alias("i"), F.xxhash64(text).alias("h"))
    number = F.xxhash64(key, F.crc32(F.col(text)))
    index = build_index(docs.select(number.alias("n"), F.col(text)), "n", text)
    hit = find_items(index, items, window=window).filter("n_hit > 0")
    hit = stage(hit.select(F.col("doc_id").alias("__hit")).distinct(), "hit")
    return docs.join(hit, number == hit["__hit"], "left_anti").select(*docs.columns)
