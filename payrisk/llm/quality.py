"""Quality classifier: naive Bayes support vectors (Wang and Manning, 2012).

N-gram indicators are scaled by the log ratio of their smoothed class shares; a linear hinge-loss
model on the scaled indicators is fitted by dual coordinate descent and mixed with the plain naive
Bayes weights. N-grams are of words, and of word shapes (letter case, digits and marks, runs taken
together) in which a word that repeats its forerunner is marked, so that junk in unseen words shows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payrisk.llm.classify import (
    Sample,
    collect_sample,
    distinct_features,
    labelled_sample,
    logistic,
    score_texts,
    sigmoid,
    weighted_sums,
)
from payrisk.llm.text import (
    EXACT,
    FOLDED,
    NOT_SPACE,
    Words,
    chain,
    mix,
    row_slices,
    span_hashes,
)

BITS = 20
#: Labelled texts that the model is fitted to, at most.
SAMPLE = 12_000
#: A feature of fewer sampled texts is not used.
LEAST = 4
COST = 1.0
EPOCHS = 12
#: Share of the naive Bayes part in the weights is 1 - BLEND.
BLEND = 0.75

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[ord("0") : ord("9") + 1] = ord("0")
_SHAPE[ord("A") : ord("Z") + 1] = ord("A")
_SHAPE[ord("a") : ord("z") + 1] = ord("a")
_SHAPE[0x80:] = ord("a")


def _shapes(words: Words) -> np.ndarray:
    """Hash of each word's shape."""
    if not len(words):
        return np.empty(0, np.uint64)
    kind = _SHAPE[words.data]
    keep = words.inside.copy()
    keep[1:] &= kind[1:] != kind[:-1]
    keep[words.starts] = True
    place = np.concatenate(([0], np.cumsum(keep)))
    return span_hashes(kind[keep], place[words.starts], place[words.ends], EXACT)


def extract(column: pa.Array) -> np.ndarray:
    """Distinct features of each text. Null and empty texts have none."""
    words = Words(column, NOT_SPACE)
    if not len(words):
        return np.empty(0, np.int64)
    row = words.row_of()
    word = words.hashes(FOLDED)
    shape = _shapes(words)
    inside = np.ones(len(row), dtype=bool)
    inside[1:] = row[1:] == row[:-1]
    inside[0] = False
    again = np.zeros(len(row), dtype=bool)
    again[1:] = inside[1:] & (word[1:] == word[:-1])
    shape = np.where(again, mix(shape ^ np.uint64(1)), shape)
    rows, hashes = [row], [word]
    for tokens, longest, kind in ((word, 2, 2), (shape, 3, 3)):
        gram, here = tokens, np.ones(len(row), dtype=bool)
        for n in range(1, longest + 1):
            if n > 1:
                gram = np.concatenate(([np.uint64(0)], chain(gram[:-1], tokens[1:])))
                here = inside & np.concatenate(([False], here[:-1]))
            if n > 1 or kind == 3:
                rows.append(row[here])
                hashes.append(mix(gram[here] + np.uint64(kind * 8 + n)))
    # How much of a text repeats: the share of distinct word pairs, in twentieths.
    pair = np.concatenate(([np.uint64(0)], chain(word[:-1], word[1:])))[inside]
    pair_row = row[inside]
    some = np.unique(pair_row)
    if len(some):
        total = np.bincount(pair_row, minlength=len(column))[some]
        packed = mix(pair + mix(pair_row.astype(np.uint64) + np.uint64(1)))
        order = np.lexsort((packed, pair_row))
        new = np.ones(len(order), dtype=bool)
        new[1:] = packed[order][1:] != packed[order][:-1]
        distinct = np.bincount(pair_row[order][new], minlength=len(column))[some]
        level = (distinct * 20 // total).astype(np.uint64)
        size = np.floor(np.log2(total + 1)).astype(np.uint64) // np.uint64(3)
        rows.append(some)
        hashes.append(mix(level * np.uint64(64) + size + np.uint64(1 << 40)))
    return distinct_features(np.concatenate(rows), np.concatenate(hashes), BITS)


@dataclass
class Model:
    """score = sigmoid(slope * (sum of weights / norm + bias) + shift)."""

    weights: np.ndarray
    ratio: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
        length = np.sqrt(np.maximum(weighted_sums(self.ratio**2, ids, rows), 0.0))
        length = np.where(length > 1e-9, length, 1.0)
        return weighted_sums(self.weights, ids, rows) / length + self.bias

    def score(self, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.margin(ids, rows) + self.shift)


def _descend(
    sample: Sample, ratio: np.ndarray, y: np.ndarray, chosen: np.ndarray, cost: float, epochs: int
) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss; classes weigh the same in all."""
    weights, bias = np.zeros(len(ratio)), 0.0
    share = np.array([np.mean(y[chosen] < 0), np.mean(y[chosen] > 0)])
    upper = cost / (2 * np.maximum(share[(y > 0).astype(int)], 1e-9))
    length = np.sqrt(weighted_sums(ratio**2, sample.ids, sample.bounds))
    length = np.where(length > 1e-9, length, 1.0)
    alpha = np.zeros(len(y))
    pick = np.random.default_rng(0)
    for _ in range(epochs):
        moved = 0.0
        for i in pick.permutation(chosen).tolist():
            ids = sample.of(i)
            x = ratio[ids] / length[i]
            square = (1.0 if len(x) else 0.0) + 1.0
            gradient = y[i] * (weights[ids] @ x + bias) - 1.0
            new = min(max(alpha[i] - gradient / square, 0.0), upper[i])
            step = (new - alpha[i]) * y[i]
            if step:
                alpha[i] = new
                weights[ids] += step * x
                bias += step
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights, bias


def train(sample: Sample, cost: float = COST, epochs: int = EPOCHS) -> Model:
    """Fit to a sample. With one class only, or none, all scores lean to that class (or to 0.5)."""
    size = 1 << BITS
    y = np.where(sample.labels > 0, 1.0, -1.0)
    positive = y > 0
    used = sample.counts(np.ones(len(y), bool), size) >= LEAST
    p = sample.counts(positive, size) + 1.0
    q = sample.counts(~positive, size) + 1.0
    ratio = np.where(used, np.log(p / p.sum()) - np.log(q / q.sum()), 0.0)
    if positive.all() or not positive.any():
        lean = 0.0 if not len(y) else (2.0 if positive.all() else -2.0)
        return Model(np.zeros(size), np.zeros(size), lean, 1.0, 0.0)
    sample = sample.only(used)
    every = np.arange(len(y))
    folds = 4

    def fit(chosen: np.ndarray) -> Model:
        w, bias = _descend(sample, ratio, y, chosen, cost, epochs)
        mean = np.abs(w[used]).mean() if used.any() else 0.0
        mixed = (1 - BLEND) * mean + BLEND * w
        return Model(mixed * ratio, ratio, bias, 1.0, 0.0)

    # Scores come from margins of texts that the model did not see.
    margins = np.zeros(len(y))
    for k in range(folds):
        margins[every % folds == k] = fit(every[every % folds != k]).margin(
            sample.ids, sample.bounds
        )[every % folds == k]
    target = np.where(
        positive, (positive.sum() + 1) / (positive.sum() + 2), 1 / ((~positive).sum() + 2)
    )
    slope, shift = logistic(margins[:, None], target, 1e-3)
    model = fit(every)
    model.slope, model.shift = float(max(slope, 1e-3)), float(shift)
    model.weights, model.ratio = model.weights.astype(np.float32), ratio.astype(np.float32)
    return model


def fit(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column,
    label: str = "quality",
    id_column: str = "doc_id",
    text: str = "text",
    sample_size: int = SAMPLE,
) -> Model:
    """Model of the texts that ``labels`` (doc_id, label) marks, rows of ``held_out`` left out."""
    sample = labelled_sample(labels, label, F.coalesce(held_out, F.lit(False)), sample_size)
    return train(collect_sample(docs, sample, extract, id_column, text))


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` without the text and with a score from 0 to 1; every row stays."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return score_texts(docs, extract, lambda i, r: shared.value.score(i, r), text, into)


def keep(docs: DataFrame, model: Model, least: float, text: str = "text") -> DataFrame:
    """The rows of ``docs``, columns unchanged, whose score is ``least`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    place = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(place)
            for a, b in row_slices(column):
                pairs = extract(column.slice(a, b - a))
                rows = np.searchsorted(pairs, np.arange(b - a + 1) << 32)
                good = shared.value.score(pairs & 0xFFFFFFFF, rows) >= least
                yield batch.slice(a, b - a).filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
