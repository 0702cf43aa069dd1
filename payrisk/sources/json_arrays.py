"""JSON files that hold one array of records (or one record), read by many tasks each.

Spark splits text files at any separator, so a file is read as the pieces that end at a closing brace.
Whether such a brace ends a record depends on what stands before it: is it inside of a string, and how
deep. A first pass over the file takes down, per split, how many quotes it has and how far the braces
go up or down, once for either way of starting. Sums over a file's splits then give each split its
true start, and the second pass cuts the records out. A record that lies over a border comes in
fragments, which are put together by file and split. Records are parsed by Spark's own parser.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: An escaped character, or a quote that begins or ends a string.
_QUOTES = re.compile(r'\\.|"', re.DOTALL)
WHOLE, HEAD, MIDDLE, TAIL = "whole", "head", "middle", "tail"


def quote_places(piece: str) -> list[int]:
    if "\\" not in piece:
        return [i for i, c in enumerate(piece) if c == '"'] if '"' in piece else []
    return [m.start() for m in _QUOTES.finditer(piece) if m.group() == '"']


def opened(piece: str, quotes: list[int], in_string: bool) -> int:
    """Opening braces of a piece that stand outside of strings."""
    if not quotes:
        return 0 if in_string else piece.count("{")
    bounds = [-1, *quotes, len(piece)]
    return sum(
        piece.count("{", a + 1, b)
        for i, (a, b) in enumerate(zip(bounds, bounds[1:]))
        if (i % 2 == 1) == in_string
    )


class Splits:
    """Pieces of a task's splits in reading order: (file, block, text)."""

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        self.batches = batches

    def __iter__(self) -> Iterator[tuple[tuple[str, int], list[str], pa.RecordBatch]]:
        """Runs of pieces of one split within a batch."""
        for batch in self.batches:
            files, blocks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts, at = batch.column(2).to_pylist(), 0
            while at < len(texts):
                key, end = (files[at], blocks[at]), at
                while end < len(texts) and files[end] == key[0] and blocks[end] == key[1]:
                    end += 1
                yield key, texts[at:end], batch.slice(at, end - at)
                at = end


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, quotes, outside, inside): per split the number of quotes, and the change of
    depth if it starts outside or inside of a string."""

    def out(key, state) -> pa.RecordBatch:
        values = (*key, *state)
        return pa.RecordBatch.from_pydict(
            {n: [v] for n, v in zip(("file", "block", "quotes", "outside", "inside"), values)}
        )

    key, state = None, [0, 0, 0]
    for now, pieces, _ in Splits(batches):
        if now != key:
            if key is not None:
                yield out(key, state)
            key, state = now, [0, 0, 0]
        for piece in pieces:
            quotes = quote_places(piece)
            for start in (False, True):
                begins = (state[0] % 2 == 1) != start
                ends = begins != (len(quotes) % 2 == 1)
                state[1 + start] += opened(piece, quotes, begins) - (not ends)
            state[0] += len(quotes)
    if key is not None:
        yield out(key, state)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, kind, text): whole records, and the fragments at the borders of splits."""
    key, parts, depth, in_string, kind = None, [], 0, False, WHOLE

    def out(rows: list[tuple[str, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {
                "file": [key[0]] * len(rows),
                "block": pa.array([key[1]] * len(rows), pa.int64()),
                "kind": [k for k, _ in rows],
                "text": [t for _, t in rows],
            }
        )

    def rest() -> list[tuple[str, str]]:
        """What a split leaves open goes on in the next one."""
        return [(MIDDLE if kind == HEAD else TAIL, "".join(parts))] if parts else []

    for now, pieces, batch in Splits(batches):
        if now != key:
            if left := rest():
                yield out(left)
            key, parts = now, []
            in_string, depth = batch.column(3)[0].as_py(), batch.column(4)[0].as_py()
            kind = HEAD if depth > 0 else WHOLE
        rows = []
        for piece in pieces:
            quotes = quote_places(piece)
            if depth == 0:
                begin = piece.find("{")
                if begin < 0:
                    continue  # brackets, commas and blanks between records
                opens = opened(piece, quotes, False)
                text = piece[begin:]
            else:
                opens, text = opened(piece, quotes, in_string), piece
            in_string = in_string != (len(quotes) % 2 == 1)
            depth += opens - (not in_string)
            parts += [text, "}"]
            if depth <= 0:
                rows.append((kind, "".join(parts)))
                parts, depth, kind = [], 0, WHOLE
        if rows:
            yield out(rows)
    if left := rest():
        yield out(left)


def read_json_arrays(
    spark: SparkSession, prefix: str, schema: T.StructType, glob: str = "*.json"
) -> DataFrame:
    """All records of the files below ``prefix``, at any depth, as columns of ``schema``.

    A file holds an array of objects, one object, or objects one after the other, over any lines.
    Fields that a record lacks are null; a record that cannot be parsed is a row of nulls, and an
    unfinished last record counts as if it ended with its file. Compressed files are one split.
    """
    pieces = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .option("lineSep", "}")
        .text(prefix)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            "value",
        )
    )
    found = pieces.mapInArrow(
        _summaries, "file string, block bigint, quotes bigint, outside bigint, inside bigint"
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    started = found.withColumn("in_string", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    change = F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside"))
    starts = (
        started.withColumn("change", change)
        .withColumn("depth", F.coalesce(F.sum("change").over(before), F.lit(0)))
        .filter("in_string or depth > 0")
        .select("file", "block", "in_string", "depth")
    )
    # One row at most per split of the input, and only for those that start within a record.
    placed = pieces.join(F.broadcast(starts), ["file", "block"], "left").select(
        "file",
        "block",
        "value",
        F.coalesce("in_string", F.lit(False)).alias("in_string"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
    )
    cut = placed.mapInArrow(_records, "file string, block bigint, kind string, text string")
    fragments = cut.filter(F.col("kind") != WHOLE)
    tail = F.when(F.col("kind") == TAIL, F.lit(1)).otherwise(F.lit(0))
    joined = (
        fragments.withColumn(
            "record", F.sum(tail).over(Window.partitionBy("file").orderBy("block", tail))
        )
        .groupBy("file", "record")
        .agg(F.sort_array(F.collect_list(F.struct("block", tail.alias("tail"), "text"))).alias("parts"))
        .select(F.array_join("parts.text", "").alias("text"))
    )
    texts = cut.filter(F.col("kind") == WHOLE).select("text").unionByName(joined)
    return texts.select(F.from_json("text", schema).alias("r")).select("r.*")
