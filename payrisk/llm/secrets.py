"""Secret scans with DataFrame functions only.

Three base kinds have a fixed form: values assigned to a telling name, access keys, and long hex
runs. Besides, two character Markov models are trained from labelled samples, one of random strings
and one of ordinary identifiers and words; a token that the first explains better by a margin is a
span of kind ``random``. Their log-likelihood ratios are one table over pairs of neighbouring
characters, fixed in size by the alphabet, so it goes into the expression itself.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payrisk.session import stage

ASSIGN = (
    "(?i)(?:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?"
    "([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex")
RANDOM = "random"
#: Characters that a token has at least for the models to look at it, with or without digits. The
#: rest of a token beside a base span is a token of its own.
LEAST = 12
TOKEN = f"[A-Za-z0-9+/_=-]{{{LEAST},}}"
#: Letters, then digits, then signs; others do not occur in a token.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: Sampled tokens of each class, at most.
SAMPLE = 20_000
#: Nats per pair of characters by which the random model has to be better.
MARGIN = 0.25
#: Characters of a token that are scored at a time; taking one character costs its place in them.
PIECE = 256


def _matches(text: Column, pattern: str) -> Column:
    """(start, end, value) of the leftmost matches that do not overlap, in code points.

    The pieces between matches and the matches alternate, so their lengths give the places."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    rows = F.transform(
        F.arrays_zip(found.alias("m"), F.slice(between, 1, F.size(found)).alias("b")),
        lambda x: F.struct(F.length(x["b"]).alias("skip"), x["m"].alias("value")),
    )
    zero = F.struct(
        F.lit(0).alias("at"),
        F.array().cast("array<struct<start:int,end:int,value:string>>").alias("out"),
    )
    return F.aggregate(
        rows,
        zero,
        lambda acc, x: F.struct(
            (acc["at"] + x["skip"] + F.length(x["value"])).alias("at"),
            F.concat(
                acc["out"],
                F.array(
                    F.struct(
                        (acc["at"] + x["skip"]).alias("start"),
                        (acc["at"] + x["skip"] + F.length(x["value"])).alias("end"),
                        x["value"].alias("value"),
                    )
                ),
            ).alias("out"),
        ),
        lambda acc: acc["out"],
    )


def _none() -> Column:
    return F.array().cast("array<struct<start:int,end:int,value:string>>")


def _if_any(text: Column, pattern: str) -> Column:
    return F.when(text.rlike(pattern), _matches(text, pattern)).otherwise(_none())


def base_matches(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with arrays __assign, __access and __hex of (start, end, value)."""
    t = F.coalesce(F.col(text), F.lit(""))
    long_enough = F.filter(
        _if_any(t, ASSIGN),
        lambda m: F.length(F.regexp_extract(m["value"], ASSIGN, 1)) >= 6,
    )
    return docs.withColumns(
        {
            "__assign": long_enough,
            "__access": _if_any(t, ACCESS),
            "__hex": _if_any(t, HEX),
        }
    )


def samples(docs: DataFrame, text: str = "text", size: int = SAMPLE) -> DataFrame:
    """(token, label): values of base matches are random strings (1), words and identifiers
    without digits ordinary ones (0). At most ``size`` distinct tokens of each, by a hash."""
    base = base_matches(docs.select(F.col(text).alias("text")))
    random = base.select(
        F.explode(
            F.concat(
                F.transform("__assign", lambda m: F.regexp_extract(m["value"], ASSIGN, 1)),
                F.transform("__access", lambda m: m["value"]),
                F.transform("__hex", lambda m: m["value"]),
            )
        ).alias("token"),
        F.lit(1).alias("label"),
    )
    words = F.regexp_extract_all(
        F.coalesce(F.col(text), F.lit("")), F.lit("[A-Za-z_]{8,}"), F.lit(0)
    )
    ordinary = docs.select(F.explode(F.array_distinct(words)).alias("token"), F.lit(0).alias("label"))

    def bounded(tokens: DataFrame) -> DataFrame:
        return tokens.distinct().orderBy(F.xxhash64("token"), "token").limit(size)

    return stage(bounded(random).unionByName(bounded(ordinary)), "secret-samples")


def train(labelled: DataFrame) -> list[float]:
    """Log-likelihood ratio, random over ordinary, of each pair of characters of the alphabet.

    ``labelled`` has columns token and label. A pair's probability is that of the second character
    after the first, with half a count added to each pair."""
    n = len(ALPHABET)
    pairs = labelled.filter(F.length("token") > 1).select(
        "label",
        F.explode(
            F.expr("transform(sequence(1, length(token) - 1), i -> substring(token, i, 2))")
        ).alias("pair"),
    )
    counts = {
        (r["label"], r["pair"]): r["n"]
        for r in pairs.groupBy("label", "pair")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("pair").rlike("^[A-Za-z0-9+/_=-]{2}$"))
        .collect()  # two classes of at most n x n pairs
    }
    ratio = []
    for a in ALPHABET:
        total = [sum(counts.get((k, a + b), 0) for b in ALPHABET) + 0.5 * n for k in (0, 1)]
        for b in ALPHABET:
            p = [(counts.get((k, a + b), 0) + 0.5) / total[k] for k in (0, 1)]
            ratio.append(round(math.log(p[1] / p[0]), 4))
    return ratio


def _score(token: str, ratio: list[float]) -> str:
    """SQL for the mean log-likelihood ratio over the pairs of characters of a token of two or
    more. Pieces overlap by one character, so every pair counts once."""
    n = len(ALPHABET)
    table = "array(" + ", ".join(f"{x!r}D" for x in ratio) + ")"
    pieces = (
        f"transform(sequence(0, (length({token}) - 2) div {PIECE}),"
        f" k -> substring({token}, cast(k * {PIECE} as int) + 1, {PIECE + 1}))"
    )
    pair = (
        f"element_at({table}, (instr('{ALPHABET}', substring(p, i, 1)) - 1) * {n}"
        f" + instr('{ALPHABET}', substring(p, i + 1, 1)))"
    )
    of_piece = f"aggregate(sequence(1, length(p) - 1), 0D, (s, i) -> s + {pair})"
    return f"aggregate({pieces}, 0D, (t, p) -> t + {of_piece}) / (length({token}) - 1)"


def scan(docs: DataFrame, ratio: list[float], text: str = "text", margin: float = MARGIN) -> DataFrame:
    """All columns of ``docs`` but the text, and arrays ``base`` and ``spans`` of (start, place of
    the kind, end, kind), sorted: the base kinds, and those with ``random`` ones that touch none.

    Null and empty texts have none; repeated rows keep a row each; columns that are named base or
    spans already are replaced."""
    rest = [F.col(c) for c in docs.columns if c not in (text, "base", "spans")]
    # Other columns wait in a struct, where their names cannot meet those made here.
    docs = docs.select(
        F.struct(F.lit(0).alias("__none"), *rest).alias("__row"), F.col(text).alias("__text")
    )
    text = "__text"

    def labelled(name: str, kind: str, place: int) -> Column:
        return F.transform(
            name,
            lambda m: F.struct(
                m["start"].alias("start"),
                F.lit(place).alias("place"),
                m["end"].alias("end"),
                F.lit(kind).alias("kind"),
            ),
        )

    t = F.coalesce(F.col(text), F.lit(""))
    found = base_matches(docs, text).withColumn(
        "base",
        F.array_sort(F.concat(*(labelled(f"__{k}", k, i) for i, k in enumerate(KINDS)))),
    )
    # Blanks in place of the base spans keep all places.
    open_ = F.aggregate(
        "base",
        t,
        lambda acc, b: F.overlay(
            acc, F.repeat(F.lit(" "), b["end"] - b["start"]), b["start"] + 1, b["end"] - b["start"]
        ),
    )
    found = found.withColumn("__open", open_).withColumn(
        "__token",
        F.filter(_if_any(F.col("__open"), TOKEN), lambda m: m["value"].rlike("[A-Za-z]")),
    )
    likely = F.expr(f"filter(__token, m -> {_score('m.value', ratio)} >= {margin}D)")
    found = found.withColumn("__random", likely)
    return found.select(
        "__row.*",
        "base",
        F.array_sort(F.concat("base", labelled("__random", RANDOM, len(KINDS)))).alias("spans"),
    ).drop("__none")


def find(docs: DataFrame, text: str = "text", size: int = SAMPLE, margin: float = MARGIN) -> DataFrame:
    """``scan`` with models trained from the documents' own samples."""
    return scan(docs, train(samples(docs, text, size)), text, margin)
