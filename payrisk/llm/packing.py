"""Vector bin packing of tokenised examples into sequences.

Each example is a vector of (tokens, segments, loss-bearing tokens), and a sequence has a limit for
each. The next piece of a sequence is the one whose vector has the largest dot product with what the
sequence still has room for, both as shares of the limits. If none fits, the largest is cut to size.
A sequence that cannot be filled keeps a power of two of tokens, which needs no padding, and the
rest goes on to the next.

Every task packs its own rows, so nothing is shuffled and a lost task is simply run again; a task
holds the tokens of ``POOL`` pieces and one slice of texts. Tokens are found per distinct chunk
between white space: the tokenizer never joins characters across it.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payrisk.llm.text import EXACT, NOT_SPACE, Words, row_slices, row_sums

MAX_TOKENS = 4096
MAX_SEGMENTS = 512
MAX_LOSS = 4096
END_ID = 2
#: Open pieces of a task from which sequences are filled.
POOL = 2048
#: Chunks whose tokens a worker keeps; others are encoded again in each slice.
KNOWN = 1_000_000
#: Text bytes that are encoded together.
SLICE = 4 << 20
_MARK = "\x01"
_JOIN = 64

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint,"
    " loss_tokens bigint, sequence_id bigint, offset bigint"
)


class Encoder:
    """Token ids of whole columns; ``ids`` equals encoding each text by itself."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark = self._encode([_MARK])[0]
        self.hashes = np.empty(0, np.uint64)
        self.starts = np.empty(0, np.int64)
        self.counts = np.empty(0, np.int64)
        self.flat = np.empty(0, np.uint32)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _chunks(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token counts and all tokens of some chunks, many chunks to a call."""
        texts = [c.decode("utf-8", "replace") for c in chunks]
        plain = [k for k, t in enumerate(texts) if _MARK not in t]
        parts: list[np.ndarray] = [np.empty(0, np.uint32)] * len(texts)
        if len(self.mark) == 1:
            joined = [plain[i : i + _JOIN] for i in range(0, len(plain), _JOIN)]
            glue = f" {_MARK} "
            for own, ids in zip(
                joined, self._encode([glue.join(texts[k] for k in own) for own in joined])
            ):
                ids = np.array(ids, dtype=np.uint32)
                cuts = np.flatnonzero(ids == self.mark[0])
                for k, a, b in zip(own, [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)]):
                    parts[k] = ids[a:b]
        else:
            plain = []
        plain_set = set(plain)
        odd = [k for k in range(len(texts)) if k not in plain_set]
        for k, ids in zip(odd, self._encode([texts[k] for k in odd])):
            parts[k] = np.array(ids, dtype=np.uint32)
        counts = np.array([len(p) for p in parts], dtype=np.int64)
        return counts, np.concatenate(parts) if parts else np.empty(0, np.uint32)

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All tokens of the rows on end, and the row bounds in them."""
        words = Words(column, NOT_SPACE)
        hashes, first, of = np.unique(words.hashes(EXACT), return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, hashes)
        at = np.minimum(at, max(len(self.hashes) - 1, 0))
        known = self.hashes[at] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)
        data = words.data.tobytes()
        spans = zip(words.starts[first[~known]].tolist(), words.ends[first[~known]].tolist())
        counts_new, flat_new = self._chunks([data[s:e] for s, e in spans])
        starts, counts = np.empty(len(hashes), np.int64), np.empty(len(hashes), np.int64)
        starts[known], counts[known] = self.starts[at[known]], self.counts[at[known]]
        starts[~known] = len(self.flat) + np.cumsum(counts_new) - counts_new
        counts[~known] = counts_new
        flat = np.concatenate((self.flat, flat_new))
        n = counts[of]
        rows = np.concatenate(([0], np.cumsum(row_sums(n, words.rows))))
        step = np.arange(rows[-1]) - np.repeat(np.cumsum(n) - n, n)
        out = flat[np.repeat(starts[of], n) + step]
        if len(self.hashes) + np.count_nonzero(~known) <= KNOWN:
            place = np.searchsorted(self.hashes, hashes[~known])
            self.hashes = np.insert(self.hashes, place, hashes[~known])
            self.starts = np.insert(self.starts, place, starts[~known])
            self.counts = np.insert(self.counts, place, counts_new)
            self.flat = flat
        return out, rows


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker and tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


@dataclass
class Piece:
    """Tokens [start, start + len(ids)) of a document; the first ``quiet`` bear no loss."""

    doc_id: int | None
    start: int
    ids: np.ndarray
    quiet: int
    doc_tokens: int

    @property
    def loss(self) -> int:
        return len(self.ids) - self.quiet

    def cut(self, n: int) -> tuple[Piece, Piece]:
        head = Piece(self.doc_id, self.start, self.ids[:n], min(self.quiet, n), self.doc_tokens)
        tail = Piece(
            self.doc_id, self.start + n, self.ids[n:], max(self.quiet - n, 0), self.doc_tokens
        )
        return head, tail

    def longest(self, tokens: int, loss: int) -> int:
        """How many of its first tokens fit both limits."""
        return min(len(self.ids), tokens, self.quiet + loss)


class Packer:
    """Pieces that wait, as arrays, and the sequences made of them."""

    def __init__(self, max_tokens: int, max_segments: int, max_loss: int):
        self.limits = np.array([max_tokens, max_segments, max_loss], dtype=np.float64)
        self.max_tokens, self.max_segments, self.max_loss = max_tokens, max_segments, max_loss
        self.pieces: list[Piece] = []
        self.sizes = np.empty((0, 3))

    def add(self, pieces: list[Piece]) -> None:
        if pieces:
            self.pieces.extend(pieces)
            new = np.array([(len(p.ids), 1, p.loss) for p in pieces], dtype=np.float64)
            self.sizes = np.concatenate((self.sizes, new / self.limits))

    def _take(self, k: int) -> Piece:
        """Remove piece k; the last one moves to its place."""
        piece, last = self.pieces[k], self.pieces.pop()
        if k < len(self.pieces):
            self.pieces[k] = last
            self.sizes[k] = self.sizes[-1]
        self.sizes = self.sizes[:-1]
        return piece

    def fill(self) -> list[Piece]:
        """One sequence."""
        made: list[Piece] = []
        tokens, loss = self.max_tokens, self.max_loss
        while self.pieces and len(made) < self.max_segments and tokens:
            room = np.array([tokens, self.max_segments - len(made), loss]) / self.limits
            fits = (self.sizes <= room + 1e-12).all(axis=1)
            if fits.any():
                piece = self._take(int(np.argmax(np.where(fits, self.sizes @ room, -1.0))))
            else:
                piece = self._take(int(np.argmax(self.sizes[:, 0])))
                n = piece.longest(tokens, loss)
                if n == 0:
                    self.add([piece])
                    break
                piece, rest = piece.cut(n)
                self.add([rest])
            made.append(piece)
            tokens -= len(piece.ids)
            loss -= piece.loss
        total = self.max_tokens - tokens
        spare = total - (1 << (total.bit_length() - 1)) if tokens else 0
        while spare:
            piece = made.pop()
            head, tail = piece.cut(max(len(piece.ids) - spare, 0))
            spare -= len(tail.ids)
            self.add([tail])
            if len(head.ids):
                made.append(head)
        return made


def _documents(ids: pa.Array, flat: np.ndarray, rows: np.ndarray, quiet: np.ndarray, end: int):
    for k, doc_id in enumerate(ids.to_pylist()):
        own = np.append(flat[rows[k] : rows[k + 1]], np.uint32(end))
        yield Piece(doc_id, 0, own, int(quiet[k]), len(own))


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text: str = "text",
    prompt: str | None = None,
    max_tokens: int = MAX_TOKENS,
    max_segments: int = MAX_SEGMENTS,
    max_loss: int = MAX_LOSS,
    end_id: int = END_ID,
    pool: int = POOL,
) -> DataFrame:
    """Pieces of all rows of ``docs``, packed: doc_id, start, length, ids_crc32, doc_tokens,
    loss_tokens, sequence_id, offset.

    A row's tokens are those of ``prompt`` (none without that column; they bear no loss), those of
    the text, and ``end_id``. Null texts are empty, so every row has a piece. Null ids and repeated
    rows are packed like others. Each token lies in exactly one piece, a sequence keeps all three
    limits, and its length is ``max_tokens`` or a power of two.
    """
    if max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")
    no_prompt = F.lit("") if prompt is None else F.coalesce(F.col(prompt), F.lit(""))
    # A blank keeps the prompt's last chunk and the text's first apart.
    chosen = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        no_prompt.alias("prompt"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    names = [part.split()[0] for part in PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        packer = Packer(max_tokens, max_segments, max_loss)
        sequence = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []

        def emit(pieces: list[Piece]) -> None:
            nonlocal sequence
            offset = 0
            for p in pieces:
                crc = zlib.crc32(p.ids.astype("<u4").tobytes())
                rows.append(
                    (p.doc_id, p.start, len(p.ids), crc, p.doc_tokens, p.loss, sequence, offset)
                )
                offset += len(p.ids)
            sequence += 1

        def close(left: int) -> None:
            while len(packer.pieces) > left:
                emit(packer.fill())

        def rest_of(doc: Piece) -> list[Piece]:
            """What is left of a long document after the sequences that it fills alone."""
            alone = Packer(max_tokens, max_segments, max_loss)
            alone.add([doc])
            while sum(len(p.ids) for p in alone.pieces) > max_tokens:
                emit(alone.fill())
            # A copy: the whole document's tokens need not wait with its end.
            return [
                Piece(p.doc_id, p.start, p.ids.copy(), p.quiet, p.doc_tokens) for p in alone.pieces
            ]

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * len(names)
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=names
            )

        for batch in batches:
            for a, b in row_slices(batch.column(2), SLICE):
                flat, bounds = encode.ids(batch.column(2).slice(a, b - a))
                quiet = np.zeros(b - a, dtype=np.int64)
                if prompt is not None:
                    first, cuts = encode.ids(batch.column(1).slice(a, b - a))
                    quiet = np.diff(cuts)
                    flat = np.concatenate(
                        [
                            part
                            for k in range(b - a)
                            for part in (
                                first[cuts[k] : cuts[k + 1]],
                                flat[bounds[k] : bounds[k + 1]],
                            )
                        ]
                    )
                    bounds = bounds + cuts
                for doc in _documents(batch.column(0).slice(a, b - a), flat, bounds, quiet, end_id):
                    packer.add(rest_of(doc) if len(doc.ids) > max_tokens else [doc])
                    if len(packer.pieces) >= pool:
                        close(pool // 2)
                yield flush()
        close(0)
        yield flush()

    return chosen.mapInArrow(run, PIECES)
