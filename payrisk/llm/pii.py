"""Personal data: seed kinds with a fixed form, and bootstrapped contextual extraction.

E-mail and network addresses, payment cards and phone numbers are found by form. They are the seed
entities: the one to three words before each are its lexical patterns. All strings that look like
identifiers, seeds or not, make a graph of patterns and instances. Spark scores it in rounds: a
pattern by the share of all its occurrences in the corpus that a trusted instance follows, an
instance by the patterns that lead to it. Patterns of high confidence then also mark identifiers
whose form is unknown. All patterns with ``LEAST_INSTANCES`` different instances are scored, however
rare they are; their occurrences are counted and their graph is scored by joins on their hashes. Only
a bitmap of a fixed size, which keeps other words out of the join, goes to all executors.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payrisk.llm import keyset
from payrisk.llm.text import (
    ALNUM,
    Words,
    chain,
    column_bytes,
    hash_text,
    mix,
    row_slices,
    row_sums,
)
from payrisk.session import stage

KINDS = ("email", "ip", "card", "phone")
FOUND = "found"
LEAST_INSTANCES = 5
CONFIDENCE = 0.7
ROUNDS = 3
LONGEST = 3

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
# A digit run that does not begin a match cannot hold one further on: so each is tried once.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LIKE = re.compile(r"[A-Za-z0-9][A-Za-z0-9._@/+-]*[A-Za-z0-9]")
_WORD = re.compile(r"[0-9A-Za-z\u0080-\U0010ffff]+")
_NOT_DIGIT = re.compile(r"[^0-9]+")
#: Characters before an identifier in which its words are looked for first.
_REACH = 120

SPAN = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
        ]
    )
)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    """Whether the check digit is right."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) of the seed kinds by start, then kind; matches of one kind do not
    overlap, and a match that fails its check is dropped without another try."""
    found = [("email", s, e) for s, e in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                found.append(("phone", m.start(), m.end()))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def other_identifiers(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Strings with four digits, or with an at sign, that no base span touches."""
    taken = sorted((s, e) for _, s, e in base)
    out, k, reach = [], 0, 0
    for m in _LIKE.finditer(text):
        s, e = m.span()
        while k < len(taken) and taken[k][0] < e:
            reach = max(reach, taken[k][1])
            k += 1
        if reach > s:
            continue
        value = m.group()
        if "@" in value or sum("0" <= c <= "9" for c in value) >= 4:
            out.append((s, e))
    return out


def contexts(text: str, start: int) -> list[str]:
    """The words before a place: the last one, the last two, up to ``LONGEST``. Words are whole
    however long they are, as ``_occurrences`` counts them."""
    reach = _REACH
    while True:
        low = max(0, start - reach)
        words = list(_WORD.finditer(text, low, start))
        if low and words and words[0].start() == low:
            del words[0]  # it may be cut
        if not low or len(words) >= LONGEST:
            break
        reach *= 4
    last = [w.group().translate(_FOLD) for w in words[-LONGEST:]]
    return [" ".join(last[-n:]) for n in range(1, len(last) + 1)]


_FOLD = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def pattern_hash(pattern: str) -> int:
    """Key of a pattern; ``_places`` gives the same for its occurrences in a text."""
    hashes = hash_text(pattern.split(" "))
    total = hashes[:1]
    for k in range(1, len(hashes)):
        total = chain(total, hashes[k : k + 1])
    return int(mix(total + np.uint64(len(hashes)))[0])


def _marked(column: pa.Array) -> np.ndarray:
    """Rows with a digit or an at sign: only these can hold an identifier."""
    out = np.zeros(len(column), dtype=bool)
    for a, b in row_slices(column):
        data, bounds = column_bytes(column.slice(a, b - a))
        hit = ((data >= 0x30) & (data <= 0x39)) | (data == 0x40)
        out[a:b] = row_sums(hit, bounds) > 0
    return out


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(0)
        rows: list[tuple[str, int, bool]] = []
        for i in np.flatnonzero(_marked(column)).tolist():
            text = column[i].as_py()
            base = base_spans(text)
            spans = [(s, e, True) for _, s, e in base]
            spans += [(s, e, False) for s, e in other_identifiers(text, base)]
            for s, e, seed in spans:
                value = xxhash.xxh64_intdigest(text[s:e].lower().encode()) - (1 << 63)
                rows += [(p, value, seed) for p in contexts(text, s)]
        columns = list(zip(*rows)) or [(), (), ()]
        types = (pa.string(), pa.int64(), pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=["pattern", "instance", "seed"]
        )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, pattern): ``pattern_hash`` of each pattern."""
    for batch in batches:
        words = Words(batch.column(0), ALNUM)
        hashes, first, n = words.hashes(), words.rows[:-1], words.per_row
        total = hashes[first]
        for k in range(1, LONGEST):
            more = n > k
            total[more] = chain(total[more], hashes[first[more] + k])
        keys = mix(total + n.astype(np.uint64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64)), batch.column(0)], names=["key", "pattern"]
        )


def _occurrences(
    batches: Iterator[pa.RecordBatch], keys: np.ndarray | keyset.KeySet
) -> Iterator[pa.RecordBatch]:
    """How often each pattern occurs before anything at all; ``keys`` are ascending, or a set that
    lets some others pass too."""

    def wanted(found: np.ndarray) -> np.ndarray:
        if isinstance(keys, keyset.KeySet):
            return keys.may_hold(found)
        return keys[np.minimum(np.searchsorted(keys, found), len(keys) - 1)] == found

    for batch in batches:
        for a, b in row_slices(batch.column(0)):
            words = Words(batch.column(0).slice(a, b - a), ALNUM)
            if not len(words):
                continue
            hashes, row = words.hashes(), words.row_of()
            grams, here = hashes, np.ones(len(hashes), dtype=bool)
            parts = []
            for n in range(1, LONGEST + 1):
                if n > 1:
                    # chain() folds from the left: extend the gram that ended one word before.
                    grams = np.concatenate(([np.uint64(0)], chain(grams[:-1], hashes[1:])))
                    same = np.concatenate(([False], row[1:] == row[:-1]))
                    here = same & np.concatenate(([False], here[:-1]))
                found = mix(grams[here] + np.uint64(n))
                parts.append(found[wanted(found)])
            found, total = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(total.astype(np.int64))],
                names=["key", "n"],
            )


def learn_patterns(
    texts: DataFrame,
    least_instances: int = LEAST_INSTANCES,
    confidence: float = CONFIDENCE,
    rounds: int = ROUNDS,
) -> list[str]:
    """Patterns of high confidence from the one text column of ``texts``, sorted."""
    spark = texts.sparkSession
    edges = stage(
        texts.mapInArrow(_edges, "pattern string, instance bigint, seed boolean")
        .groupBy("pattern", "instance", "seed")
        .agg(F.count(F.lit(1)).alias("n")),
        "pattern-edges",
    )
    support = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("instances"))
    names = stage(
        support.filter(F.col("instances") >= least_instances)
        .select("pattern")
        .mapInArrow(_hashed, "key bigint, pattern string"),
        "pattern-names",
    )
    shared = spark.sparkContext.broadcast(keyset.build(names, "key"))
    counted = (
        texts.mapInArrow(lambda b: _occurrences(b, shared.value), "key bigint, n bigint")
        .groupBy("key")
        .agg(F.sum("n").alias("all"))
    )
    patterns = stage(names.join(counted, "key"), "patterns")
    graph = stage(
        edges.join(patterns, "pattern").select("key", "instance", "seed", "n", "all"),
        "pattern-graph",
    )
    trust = stage(
        graph.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("trust")), "trust"
    )
    for _ in range(rounds):
        scores = stage(_pattern_scores(graph, trust).filter(F.col("score") >= 0.5), "pattern-scores")
        good = F.least(F.coalesce("score", F.lit(0.0)), F.lit(0.99))
        trust = stage(
            graph.join(scores, "key", "left")
            .groupBy("instance")
            .agg(
                F.greatest(
                    F.max(F.col("seed").cast("double")),
                    1 - F.exp(F.sum(F.log(1 - good))),
                ).alias("trust")
            ),
            "trust",
        )
    final = _pattern_scores(graph, trust).filter(
        (F.col("score") >= confidence) & (F.col("trusted") >= least_instances)
    )
    return sorted(r["pattern"] for r in patterns.join(final, "key").select("pattern").collect())


def _pattern_scores(graph: DataFrame, trust: DataFrame) -> DataFrame:
    """Share of a pattern's occurrences that a trusted instance follows, and how many different."""
    return (
        graph.join(trust, "instance")
        .groupBy("key")
        .agg(
            (F.sum(F.col("n") * F.col("trust")) / F.max("all")).alias("score"),
            F.sum("trust").alias("trusted"),
        )
    )


def all_spans(text: str, patterns: frozenset[str]) -> list[tuple[str, int, int]]:
    """Base spans, and identifiers after a pattern as kind ``FOUND``, in order."""
    spans = base_spans(text)
    if patterns:
        more = [
            (FOUND, s, e)
            for s, e in other_identifiers(text, spans)
            if any(p in patterns for p in contexts(text, s))
        ]
        spans = sorted(spans + more, key=lambda x: (x[1], (*KINDS, FOUND).index(x[0])))
    return spans


def find(docs: DataFrame, patterns: list[str], text: str = "text", into: str = "spans") -> DataFrame:
    """All columns of ``docs`` but the text, and the spans (kind, start, end) in code points, by
    start, then kind. Null and empty texts have none; repeated rows keep a row each; a column that
    is named ``into`` already is replaced."""
    rest = [c for c in docs.columns if c not in (text, into)]
    known = frozenset(patterns)
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(rest))
            spans: list[list[dict]] = [[] for _ in range(len(column))]
            for i in np.flatnonzero(_marked(column)).tolist():
                spans[i] = [
                    {"kind": k, "start": s, "end": e}
                    for k, s, e in all_spans(column[i].as_py(), known)
                ]
            arrays = [batch.column(i) for i in range(len(rest))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(spans, kind)], names=[*rest, into])

    schema = docs.select(*rest).schema.add(into, SPAN)
    return docs.select(*rest, text).mapInArrow(run, schema)


def redact_text(text: str, patterns: frozenset[str]) -> str:
    """The text with every span replaced by its kind; spans that overlap go as one, by the first."""
    out, done = [], 0
    for kind, start, end in all_spans(text, patterns):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, patterns: list[str], text: str = "text") -> DataFrame:
    """``docs`` with personal data masked in the text; null texts stay null."""
    known, names = frozenset(patterns), docs.columns
    place = names.index(text)

    def masked(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column(place)
        marked = np.flatnonzero(_marked(column)).tolist()
        if not marked:
            return batch
        texts = column.to_pylist()
        for i in marked:
            texts[i] = redact_text(texts[i], known)
        arrays = list(batch.columns)
        arrays[place] = pa.array(texts, pa.string())
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in row_slices(batch.column(place)):
                yield masked(batch.slice(a, b - a))

    return docs.mapInArrow(run, docs.schema)
