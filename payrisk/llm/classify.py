"""What the text classifiers share: labelled samples, hashed features, scoring of whole tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payrisk.llm.text import row_slices, row_sums

#: (row << 32 | feature), ascending and distinct, for a slice of texts.
Extract = Callable[[pa.Array], np.ndarray]


def distinct_features(row: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    """Pairs of row and hashed feature, each once."""
    return np.unique(row.astype(np.int64) << 32 | (hashes >> np.uint64(64 - bits)).astype(np.int64))


def labelled_sample(
    labels: DataFrame, label: str, held_out: Column, size: int, id_column: str = "doc_id"
) -> DataFrame:
    """(doc_id, label) of at most ``size`` ids that are not held out, picked by a hash of the id.

    Ids whose rows name both labels, and null ids and labels, are left out.
    """
    return (
        labels.filter(F.col(label).isNotNull() & F.col(id_column).isNotNull() & ~held_out)
        .groupBy(F.col(id_column).cast("long").alias("doc_id"))
        .agg(F.min(label).alias("label"), F.max(label).alias("most"))
        .filter("label = most")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(size)
        .select("doc_id", F.col("label").cast("int").alias("label"))
    )


#: Features that are looked up at once; bounds the working memory.
_BLOCK = 1 << 18


def _blocks(rows: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows with few features each, but of one row at least."""
    at, n = 0, len(rows) - 1
    while at < n:
        end = int(np.searchsorted(rows, rows[at] + _BLOCK, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end


def weighted_sums(weights: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Per row the sum of its features' weights; ``rows`` are the n+1 bounds in ``ids``."""
    out = np.zeros(len(rows) - 1)
    for a, b in _blocks(rows):
        own = weights[ids[rows[a] : rows[b]]].astype(np.float64)
        out[a:b] = row_sums(own, rows[a : b + 1] - rows[a])
    return out


class Sample:
    """Features of the sampled texts: ``ids[bounds[i]:bounds[i + 1]]`` are those of text i."""

    def __init__(self, labels: np.ndarray, ids: np.ndarray, bounds: np.ndarray):
        self.labels, self.ids, self.bounds = labels, ids, bounds

    def __len__(self) -> int:
        return len(self.labels)

    def of(self, i: int) -> np.ndarray:
        return self.ids[self.bounds[i] : self.bounds[i + 1]]

    def blocks(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(text, feature) of all texts, a block at a time."""
        for a, b in _blocks(self.bounds):
            text = np.repeat(np.arange(a, b), np.diff(self.bounds[a : b + 1]))
            yield text, self.ids[self.bounds[a] : self.bounds[b]]

    def counts(self, which: np.ndarray, size: int) -> np.ndarray:
        """Number of the chosen texts that have each feature."""
        out = np.zeros(size, dtype=np.int64)
        for text, ids in self.blocks():
            np.add.at(out, ids[which[text]], 1)
        return out

    def only(self, used: np.ndarray) -> Sample:
        """The same texts with some features only."""
        parts = [(text[used[ids]], ids[used[ids]]) for text, ids in self.blocks()]
        n = np.zeros(len(self), dtype=np.int64)
        for text, _ in parts:
            np.add.at(n, text, 1)
        ids = np.concatenate([i for _, i in parts]) if parts else self.ids
        return Sample(self.labels, ids, np.concatenate(([0], np.cumsum(n))))


def collect_sample(
    docs: DataFrame, sample: DataFrame, extract: Extract, id_column: str, text: str
) -> Sample:
    """Features of the sample's texts; only these few texts are looked at, and the sample's size
    bounds what is broadcast and what comes back. Copies of one text count once."""
    chosen = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t")
    ).join(F.broadcast(sample), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in row_slices(batch.column(2)):
                pairs = extract(batch.column(2).slice(a, b - a))
                cuts = np.searchsorted(pairs, np.arange(b - a + 1) << 32).astype(np.int32)
                ids = pa.array((pairs & 0xFFFFFFFF).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        batch.column(1).slice(a, b - a),
                        pa.ListArray.from_arrays(cuts, ids),
                    ],
                    names=["doc_id", "label", "ids"],
                )

    found = chosen.select("doc_id", F.col("label").cast("int"), "t").mapInArrow(
        run, "doc_id bigint, label int, ids array<int>"
    )
    rows = []
    for batch in found.toArrow().to_batches():
        lists = batch.column(2)
        values, cuts = lists.values.to_numpy(), lists.offsets.to_numpy()
        for k, (doc_id, label) in enumerate(
            zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        ):
            ids = values[cuts[k] : cuts[k + 1]]
            digest = hashlib.blake2b(ids.tobytes(), digest_size=16).digest()
            rows.append((doc_id, label, digest, ids))
    rows.sort(key=lambda row: row[:3])
    seen: set[tuple[int, bytes]] = set()
    rows = [r for r in rows if not (r[1:3] in seen or seen.add(r[1:3]))]
    bounds = np.concatenate(([0], np.cumsum([len(r[3]) for r in rows]))).astype(np.int64)
    ids = np.concatenate([r[3] for r in rows]) if rows else np.empty(0, np.int32)
    return Sample(np.array([r[1] for r in rows], dtype=np.int64), ids, bounds)


def score_texts(
    docs: DataFrame,
    extract: Extract,
    score: Callable[[np.ndarray, np.ndarray], np.ndarray],
    text: str = "text",
    into: str = "score",
) -> DataFrame:
    """All columns of ``docs`` but the text, and ``score(features, row bounds)`` of each text. A
    column that is named ``into`` already is replaced."""
    rest = [c for c in docs.columns if c not in (text, into)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(rest))
            parts = [np.empty(0)]
            for a, b in row_slices(column):
                pairs = extract(column.slice(a, b - a))
                rows = np.searchsorted(pairs, np.arange(b - a + 1) << 32)
                parts.append(score(pairs & 0xFFFFFFFF, rows))
            arrays = [batch.column(i) for i in range(len(rest))]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(np.concatenate(parts))], names=[*rest, into]
            )

    schema = docs.select(*rest).schema.add(into, "double")
    return docs.select(*rest, text).mapInArrow(run, schema)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def logistic(
    x: np.ndarray, y: np.ndarray, penalty: float, center: np.ndarray | None = None
) -> np.ndarray:
    """Weights (the last is the bias) of a logistic fit to labels in [0, 1], by Newton steps.

    ``penalty`` pulls all weights but the bias towards ``center``."""
    x = np.hstack([x, np.ones((len(x), 1))])
    center = np.zeros(x.shape[1]) if center is None else np.append(center, 0.0)
    pull = np.full(x.shape[1], penalty)
    pull[-1] = 1e-6
    w = center.copy()
    for _ in range(50):
        p = sigmoid(x @ w)
        gradient = x.T @ (p - y) + pull * (w - center)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w
