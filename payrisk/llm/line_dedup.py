"""Removal of lines that many documents share.

Every line's key gets a 128-bit hash. The (hash, document, position) rows are dealt out by range and
sorted, so that one pass over a task's rows meets each hash's documents in order, first occurrence
first. What goes back to a document is not text but a compressed bitmap of the lines it keeps.

Ranges cut through a hash with many rows, so no task holds a common line alone. Of the rows of a hash
that reaches over a cut, a task drops what it can decide by itself; the few others (a hash at a cut
with too few documents on this side) are settled by a join with what both sides have counted.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payrisk.llm.text import row_slices
from payrisk.session import stage

MIN_DOCS = 10
#: Stripped at both ends of a line before lines are compared.
SPACE = b" \t\n\x0b\x0c\r"

_PLACE = ["doc_id", "text_hash", "pos"]
_SORTED = ["h1", "h2", *_PLACE]
#: What a task knows about a row: its line goes; it goes, and its hash lies at a cut; not decided.
GOES, GOES_AT_CUT, OPEN = 0, 1, 2


def _texts(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def line_keys(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(h1, h2, doc_id, text_hash, pos) of each line whose key is not empty."""
    slim = docs.select(
        F.col(id_column).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")
    )
    kind = slim.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for start, end in row_slices(batch.column(2)):
                rows, places, hashes = [], [], []
                for row, body in enumerate(_texts(batch.column(2).slice(start, end - start)), start):
                    for place, line in enumerate(body.split(b"\n")):
                        if key := line.strip(SPACE).lower():  # of bytes: A-Z only
                            rows.append(row)
                            places.append(place)
                            hashes.append(digest(key))
                h = np.frombuffer(b"".join(hashes), dtype="<i8").reshape(-1, 2)
                at = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.ascontiguousarray(h[:, 0])),
                        pa.array(np.ascontiguousarray(h[:, 1])),
                        batch.column(0).take(at),
                        batch.column(1).take(at),
                        pa.array(places, pa.int64()),
                    ],
                    names=_SORTED,
                )

    return slim.mapInArrow(run, f"h1 bigint, h2 bigint, doc_id {kind}, text_hash bigint, pos bigint")


def _changes(table: pa.Table, columns: list[str]) -> np.ndarray:
    """True where a row differs from the one before it in one of the columns; nulls are equal."""
    changed = np.zeros(table.num_rows, dtype=bool)
    changed[:1] = True
    for name in columns:
        codes = table.column(name).combine_chunks().dictionary_encode(null_encoding="encode").indices
        codes = codes.to_numpy(zero_copy_only=False)
        changed[1:] |= codes[1:] != codes[:-1]
    return changed


def _stream(
    batches: Iterator[pa.RecordBatch], min_docs: int, keep_first: bool
) -> Iterator[pa.RecordBatch]:
    """Rows that go or are open, with their ``state`` and whether they are the ``first`` of their
    hash in this task. Held back are the rows of one hash, while its documents are too few."""
    held: pa.Table | None = None
    # The hash that the rows held belong to: has it begun this task, and what has been sent already.
    begins, sent = True, False

    def told(rows: pa.Table, state: int, first: bool) -> Iterator[pa.RecordBatch]:
        firsts = np.zeros(rows.num_rows, dtype=bool)
        firsts[:1] = first
        rows = rows.append_column("state", pa.array(np.full(rows.num_rows, state, dtype=np.int32)))
        yield from rows.append_column("first", pa.array(firsts)).to_batches()

    def decided(rows: pa.Table, at_cut: bool, first: bool) -> Iterator[pa.RecordBatch]:
        if not at_cut and first and keep_first:
            rows, first = rows.slice(1), False
        yield from told(rows, GOES_AT_CUT if at_cut else GOES, first)

    for batch in batches:
        if not batch.num_rows:
            continue
        fresh = pa.Table.from_batches([batch])
        if held is not None:
            fresh = pa.concat_tables([held, fresh])
        table = fresh
        runs = np.flatnonzero(_changes(table, ["h1", "h2"]))
        bounds = np.append(runs, table.num_rows)
        by_id = _changes(table, ["h1", "h2", "doc_id"])
        nameless = table.column("doc_id").combine_chunks().is_null().to_numpy(zero_copy_only=False)
        documents = np.where(nameless, _changes(table, ["h1", "h2", "text_hash"]), by_id)
        counts = np.add.reduceat(documents, runs)
        ends = len(runs) - 1
        # Whole hashes inside of the batch: all their rows in one step.
        inner = np.flatnonzero(counts[1:ends] >= min_docs) + 1 if ends > 1 else np.empty(0, int)
        if len(inner):
            take = np.zeros(table.num_rows + 1, dtype=np.int64)
            first = bounds[inner] + (1 if keep_first else 0)
            take[first] += 1
            np.add.at(take, bounds[inner + 1], -1)
            gone = np.flatnonzero(np.cumsum(take[:-1]) > 0)
            part = table.take(pa.array(gone))
            flags = np.zeros(len(gone), dtype=bool)
            if not keep_first:
                flags = np.isin(gone, first)
            part = part.append_column("state", pa.array(np.full(len(gone), GOES, dtype=np.int32)))
            yield from part.append_column("first", pa.array(flags)).to_batches()
        if ends:  # the first hash of the batch ends here
            rows = table.slice(0, int(bounds[1]))
            if sent:
                yield from told(rows.slice(1), GOES_AT_CUT if begins else GOES, False)
            elif counts[0] >= min_docs:
                yield from decided(rows, begins, True)
            elif begins:
                yield from told(rows, OPEN, True)
            begins, sent = False, False
        rows = table.slice(int(bounds[ends]))
        if sent:
            yield from told(rows.slice(1), GOES_AT_CUT, False)
            held = rows.slice(rows.num_rows - 1)
        elif counts[ends] >= min_docs:
            # It may reach the cut at the end of the task: that is settled with the others there.
            yield from told(rows, GOES_AT_CUT, True)
            held, sent = rows.slice(rows.num_rows - 1), True
            begins = True
        else:
            held = rows
    if held is not None and not sent:
        yield from told(held, OPEN, True)


def dropped_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    min_docs: int = MIN_DOCS,
    keep_first: bool = False,
) -> DataFrame:
    """(doc_id, text_hash, pos) of the lines that go; equal rows of ``docs`` give equal rows here."""
    if min_docs < 1:
        raise ValueError("min_docs must be 1 at least")
    keys = line_keys(docs, id_column, text)
    ordered = keys.repartitionByRange(*_SORTED).sortWithinPartitions(*_SORTED)
    schema = [*(f"{f.name} {f.dataType.simpleString()}" for f in keys.schema), "state int", "first boolean"]
    found = stage(
        ordered.mapInArrow(lambda batches: _stream(batches, min_docs, keep_first), ", ".join(schema)),
        "lines",
    )
    # At cuts: two hashes a task at most, of which one row each, or those of too few documents.
    document = F.struct("doc_id", F.when(F.col("doc_id").isNull(), F.col("text_hash")))
    place = F.struct(*_PLACE)
    both_sides = (
        found.filter((F.col("state") == OPEN) | ((F.col("state") == GOES_AT_CUT) & F.col("first")))
        .groupBy("h1", "h2")
        .agg(
            F.max(F.col("state") == GOES_AT_CUT).alias("enough"),
            F.count_distinct(document).alias("n"),
            F.min(place).alias("earliest"),
        )
        .select("h1", "h2", (F.col("enough") | (F.col("n") >= min_docs)).alias("goes"), "earliest")
    )
    both_sides = stage(both_sides, "cuts")
    # With keep_first the row that a task met first is open until the cuts are compared.
    unsettled = F.col("state") == OPEN
    if keep_first:
        unsettled = unsettled | ((F.col("state") == GOES_AT_CUT) & F.col("first"))
    settled = found.filter(unsettled).join(both_sides, ["h1", "h2"]).filter("goes")
    if keep_first:
        settled = settled.filter(place != F.col("earliest"))
    return found.filter(~unsettled).select(*_PLACE).unionByName(settled.select(*_PLACE))


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmaps of kept lines from the words (at, bits) of dropped ones; bit i is line i. Lines
    beyond its end stay."""
    for batch in batches:
        keeps, counts = [], []
        for words in batch.column(2).to_pylist():
            bits = np.full(max(w["at"] for w in words) + 1, -1, dtype="<i8")
            for w in words:
                bits[w["at"]] = ~w["bits"]
            keeps.append(zlib.compress(bits.tobytes()))
            counts.append(int(np.bitwise_count((~bits).view("<u8")).sum()))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(counts, pa.int64()),
                pa.array(keeps, pa.binary()),
            ],
            names=["doc_id", "text_hash", "n_dropped", "keep"],
        )


def keep_bitmaps(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    min_docs: int = MIN_DOCS,
    keep_first: bool = False,
) -> DataFrame:
    """(doc_id, text_hash, n_dropped, keep): the compressed bitmap of the lines that a document keeps.

    Lines end at a line feed; their key is the line without white space at both ends, A-Z in lower
    case. Lines of a key that occurs in ``min_docs`` documents go, all of them or, with
    ``keep_first``, all but the first by document id and position. Empty keys never go.

    One row per different (id, text) that loses lines; others keep all. Null and empty texts have one
    empty line, which stays. Rows that share an id are one document when documents are counted; rows
    without id are told apart by their text. Other columns of ``docs`` are not looked at.
    """
    gone = dropped_lines(docs, id_column, text, min_docs, keep_first)
    # Words of 64 lines; repeated rows of docs set the same bits.
    bit = F.expr("shiftleft(1L, cast(pos % 64 as int))")
    words = gone.groupBy("doc_id", "text_hash", F.expr("cast(pos div 64 as int)").alias("at")).agg(
        F.bit_or(bit).alias("bits")
    )
    by_doc = words.groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("at", "bits")).alias("words")
    )
    kind = docs.schema[id_column].dataType.simpleString()
    return by_doc.mapInArrow(
        _compressed, f"doc_id {kind}, text_hash bigint, n_dropped bigint, keep binary"
    )


def kept_lines(body: bytes, keep: bytes | None) -> bytes:
    """The lines of a text that its bitmap keeps."""
    if keep is None:
        return body
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")
    lines = body.split(b"\n")
    flags = bits[: len(lines)].tolist()
    flags += [1] * (len(lines) - len(flags))
    return b"\n".join(line for line, flag in zip(lines, flags) if flag)


def kept_texts(
    docs: DataFrame, bitmaps: DataFrame, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with the kept lines as text (null texts become empty), n_lines (before) and n_dropped.

    Repeated rows stay repeated. Columns that are named n_lines or n_dropped already are replaced.
    """
    rest = [c for c in docs.columns if c not in (text, "n_lines", "n_dropped")]
    own = docs.select(F.struct(*rest).alias("own"), F.col(text).alias("text"))
    own = own.withColumn("h", F.xxhash64("text"))
    found = bitmaps.select(F.col("doc_id").alias("key"), F.col("text_hash").alias("th"), "n_dropped", "keep")
    match = F.col(f"own.`{id_column}`").eqNullSafe(F.col("key")) & (F.col("h") == F.col("th"))
    joined = own.join(found, match, "left").select("own", "text", "n_dropped", "keep")
    schema = own.select("own").schema.add("text", "string").add("n_lines", "long").add("n_dropped", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in row_slices(batch.column(1)):
                part = batch.slice(start, end - start)
                bodies = _texts(part.column(1))
                kept = [kept_lines(b, k) for b, k in zip(bodies, part.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                        pa.array([b.count(b"\n") + 1 for b in bodies], pa.int64()),
                        part.column(2).fill_null(0),
                    ],
                    names=["own", "text", "n_lines", "n_dropped"],
                )

    done = joined.mapInArrow(run, schema)
    return done.select("own.*", F.col("text").alias(text), "n_lines", "n_dropped")
