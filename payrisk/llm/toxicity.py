"""Toxicity scores by weak supervision.

Many voters look at a text: lexicons (a short general one, and words and word beginnings that set
toxic training texts apart, grouped by how they occur together) and patterns (shouting, marks of
shouting, masked words). A generative model with one hidden class per text estimates by expectation
maximisation how often each voter speaks in either class. Voters that agree more than the class
explains share their weight. The training labels are one more voter. A linear classifier is then
fitted to the posterior labels, so scoring needs neither voters nor labels.
"""

from __future__ import annotations

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
from payrisk.llm.text import ALNUM, FOLDED, Words, hash_text, mix, span_hashes

BITS = 20
#: Labelled texts that voters and classifier are fitted to, at most.
SAMPLE = 12_000
#: Words and word beginnings in the lexicons, at most; the strongest are taken.
LEXICON = 400
#: Lexicon voters.
VOTERS = 48
PREFIXES = (3, 4, 5)
#: A general lexicon, for samples that show little.
GENERAL = """
    idiot idiots moron morons stupid dumb loser losers pathetic worthless trash scum clown
    disgusting imbecile retard bastard bitch asshole fuck fucking shit whore slut
    dummkopf arschloch scheisse hurensohn wichser
    connard salope merde enculé
    imbécil estúpido pendejo puta mierda gilipollas
""".split()
PATTERNS = ("shouting", "exclaiming", "masking")
_WORD, _START, _PATTERN = np.uint64(1), np.uint64(100), np.uint64(200)


def _pattern_id(k: int) -> np.uint64:
    return mix(np.array([k], dtype=np.uint64) + _PATTERN)[0]


def extract(column: pa.Array) -> np.ndarray:
    """Distinct features of each text: words, word beginnings and patterns."""
    words = Words(column, ALNUM)
    row = words.row_of()
    rows, hashes = [row], [mix(words.hashes(FOLDED) + _WORD)]
    long = words.ends - words.starts
    for n in PREFIXES:
        at = long > n
        part = span_hashes(words.data, words.starts[at], words.starts[at] + n, FOLDED)
        rows.append(row[at])
        hashes.append(mix(part + _START + np.uint64(n)))
    data, bounds = words.data, words.bounds

    def per_row(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask)))
        return total[bounds[1:]] - total[bounds[:-1]]

    upper = per_row((data >= 0x41) & (data <= 0x5A))
    lower = per_row((data >= 0x61) & (data <= 0x7A))
    twice = np.concatenate((data[1:] == data[:-1], [False])) if len(data) else data == 0
    found = (
        (upper > lower) & (upper >= 20),
        per_row((data == ord("!")) & twice) >= 2,
        per_row((data == ord("*")) & twice) >= 1,
    )
    for k, hit in enumerate(found):
        at = np.flatnonzero(hit)
        rows.append(at)
        hashes.append(np.full(len(at), _pattern_id(k)))
    return distinct_features(np.concatenate(rows), np.concatenate(hashes), BITS)


def _feature(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def _g2(p: np.ndarray, q: np.ndarray, n_p: int, n_q: int) -> np.ndarray:
    """Likelihood-ratio statistic of each feature against the class, where it favours toxic."""
    rate = (p + q) / (n_p + n_q)

    def part(k, n, r):
        return np.where(k > 0, k * np.log(np.maximum(k, 1) / np.maximum(n * r, 1e-12)), 0.0)

    g = 2 * (part(p, n_p, rate) + part(n_p - p, n_p, 1 - rate))
    g += 2 * (part(q, n_q, rate) + part(n_q - q, n_q, 1 - rate))
    return np.where(p * n_q > q * n_p, g, 0.0)


def _apart(sample: Sample, which: np.ndarray, bands: int = 12, per_band: int = 8) -> np.ndarray:
    """``which`` without near copies, whose shared words would pass for signs of the class."""
    seen: set[tuple[int, bytes]] = set()
    keep = which.copy()
    salts = mix(np.arange(1, bands * per_band + 1, dtype=np.uint64))[:, None]
    for i in np.flatnonzero(which).tolist():
        ids = sample.of(i).astype(np.uint64)
        if not len(ids):
            continue
        least = mix(ids[None, :] * np.uint64(0x9E3779B97F4A7C15) ^ salts).min(axis=1)
        keys = {(k, least[k * per_band : (k + 1) * per_band].tobytes()) for k in range(bands)}
        keep[i] = not keys & seen
        seen |= keys
    return keep


def lexicon(sample: Sample, size: int = LEXICON) -> np.ndarray:
    """Features that mark toxic texts more surely than chance over all features allows, strongest
    first, then the general lexicon."""
    general = np.unique(_feature(mix(hash_text(GENERAL) + _WORD)))
    toxic = sample.labels > 0
    if not toxic.any() or toxic.all():
        return general
    apart = _apart(sample, toxic)
    p = sample.counts(apart, 1 << BITS)
    q = sample.counts(~toxic, 1 << BITS)
    g = _g2(p, q, int(apart.sum()), int((~toxic).sum()))
    least = 10 + 2 * np.log(max(np.count_nonzero(p + q >= 3), 1))
    strong = np.argsort(-g, kind="stable")[:size]
    strong = strong[(g[strong] >= least) & (p[strong] >= 10 * q[strong])]
    return np.concatenate((strong, general[~np.isin(general, strong)]))


def _matrix(sample: Sample, features: np.ndarray) -> np.ndarray:
    """Whether each text has each feature."""
    place = np.full(1 << BITS, -1, dtype=np.int64)
    place[features] = np.arange(len(features))
    out = np.zeros((len(sample), len(features)), dtype=bool)
    for text, ids in sample.blocks():
        at = place[ids]
        out[text[at >= 0], at[at >= 0]] = True
    return out


def voters_of(has: np.ndarray, most: int = VOTERS) -> np.ndarray:
    """Votes of the lexicon voters: features that mostly occur together make one voter."""
    votes: list[np.ndarray] = []
    for column in has.T:
        if not column.any():
            continue
        overlap = [(column & v).sum() / max((column | v).sum(), 1) for v in votes]
        best = int(np.argmax(overlap)) if overlap else -1
        if best >= 0 and (overlap[best] >= 0.5 or len(votes) >= most):
            votes[best] = votes[best] | column
        else:
            votes.append(column.copy())
    return np.array(votes, dtype=bool).T.reshape(len(has), -1)


@dataclass
class LabelModel:
    """How often each voter speaks in toxic and other texts, the prior, and the voters' shares."""

    speaks: np.ndarray  # 2 x voters: other, toxic
    prior: float
    shares: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        yes = np.log(self.speaks[1] / self.speaks[0])
        no = np.log((1 - self.speaks[1]) / (1 - self.speaks[0]))
        evidence = votes @ (yes * self.shares) + (~votes) @ (no * self.shares)
        return sigmoid(np.log(self.prior / (1 - self.prior)) + evidence)


def fit_label_model(votes: np.ndarray, start: np.ndarray, rounds: int = 30) -> LabelModel:
    """Expectation maximisation from the posterior ``start``; after it has settled, voters get
    shares by their remaining correlations, and it settles again."""
    p = start.copy()
    shares = np.ones(votes.shape[1])
    model = LabelModel(np.full((2, votes.shape[1]), 0.5), 0.5, shares)
    for correlated in (False, True):
        if correlated:
            residual = votes - (p[:, None] * model.speaks[1] + (1 - p)[:, None] * model.speaks[0])
            spread = np.sqrt(np.maximum((residual**2).mean(axis=0), 1e-12))
            rho = (residual.T @ residual) / len(votes) / np.outer(spread, spread)
            np.fill_diagonal(rho, 0.0)
            shares = 1.0 / (1.0 + np.where(rho > 0.1, rho, 0.0).sum(axis=1))
        for _ in range(rounds):
            toxic, other = p.sum(), (1 - p).sum()
            speaks = np.vstack(
                [
                    ((1 - p) @ votes + 0.02) / (other + 1.0),
                    (p @ votes + 0.1) / (toxic + 1.0),
                ]
            )
            model = LabelModel(
                np.clip(speaks, 1e-4, 1 - 1e-4),
                float(np.clip(toxic / max(len(p), 1), 1e-3, 0.5)),
                shares,
            )
            new = model.posterior(votes)
            done = np.abs(new - p).max() < 1e-4
            p = new
            if done:
                break
    return model


@dataclass
class Model:
    features: np.ndarray
    weights: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        out = np.zeros(1 << BITS, dtype=np.float64)
        out[self.features] = self.weights
        return out


def train(sample: Sample) -> Model:
    """Voters, label model and classifier of a sample."""
    features = lexicon(sample)
    patterns = _feature(np.array([_pattern_id(k) for k in range(len(PATTERNS))]))
    features = np.concatenate((features, patterns[~np.isin(patterns, features)]))
    general = _feature(mix(hash_text(GENERAL) + _WORD))
    center = np.where(np.isin(features, general), 4.0, 0.0)
    if not len(sample):
        return Model(features, center, -2.0)
    has = _matrix(sample, features)
    n_words = len(features) - len(PATTERNS)
    words = voters_of(has[:, :n_words])
    votes = np.hstack(
        [
            words,
            has[:, :n_words].any(axis=1, keepdims=True),
            has[:, n_words:],
            (sample.labels > 0)[:, None],
        ]
    )
    start = np.where(sample.labels > 0, 0.95, 0.05)
    posterior = fit_label_model(votes, start).posterior(votes)
    x = has.astype(np.float64)
    weights = logistic(x, posterior, 0.02, center)
    return Model(features, weights[:-1], float(weights[-1]))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column,
    label: str = "toxic",
    id_column: str = "doc_id",
    text: str = "text",
    sample_size: int = SAMPLE,
) -> Model:
    """Model of the texts that ``labels`` (doc_id, label) marks, rows of ``held_out`` left out."""
    sample = labelled_sample(labels, label, F.coalesce(held_out, F.lit(False)), sample_size)
    return train(collect_sample(docs, sample, extract, id_column, text))


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` without the text and with a score from 0 to 1. Every row stays; null and empty
    texts have the score of a text without any sign."""
    shared = docs.sparkSession.sparkContext.broadcast((model.table(), model.bias))

    def run(ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
        table, bias = shared.value
        return sigmoid(weighted_sums(table, ids, rows) + bias)

    return score_texts(docs, extract, run, text, into)
