"""Behaviour of a card over the last 5 minutes, 10 minutes and hour.

Frames reach back from each payment over whole epoch seconds, both ends included, and take in all
payments of the payment's own second. Instead of gathering the frame's values for every row, which
costs rows x frame size on a busy card, every feature is a difference of two running totals:

* payments in the last s seconds = total up to t - total up to t - s - 1;
* a distinct value is "active" from its first sight until s seconds after its last one. Sightings
  at most s apart belong to one run. So distinct values in the frame = runs opened up to t - runs
  whose last sighting is at most t - s - 1.

The work is linear in a card's seconds after sorting, whatever the frame holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payrisk.functions.rules import declined
from payrisk.functions.values import epoch_second

# Frame lengths in seconds.
VELOCITY_S = 300
MERCHANTS_S = 600
COUNTRIES_S = 3600
DECLINED_S = 3600
LONGEST_S = max(VELOCITY_S, MERCHANTS_S, COUNTRIES_S, DECLINED_S)

# Width of the time slices into which a card's per-second totals are cut.
SLICE_S = 86_400

CARD_FEATURES = [
    "tx_by_card_5m",
    "distinct_merchants_10m",
    "distinct_countries_1h",
    "declined_ratio_1h",
]


def _run_edges(value: str, group: str, span: str | int) -> tuple[Column, Column]:
    """(opens, closes): 1 where a run of sightings of ``value`` starts or ends, else 0."""
    over = f"OVER (PARTITION BY {group}, {value} ORDER BY at_s)"

    def edge(gap: str) -> Column:
        return F.expr(f"CAST({value} IS NOT NULL AND NOT coalesce({gap} <= {span}, false) AS INT)")

    return edge(f"at_s - lag(at_s) {over}"), edge(f"lead(at_s) {over} - at_s")


def _with_features(per_time: DataFrame, group: str, keep: list[str], wanted: list[str]) -> DataFrame:
    """``keep`` and the wanted features, from the totals per second ordered by at_s."""

    def up_to(column: str, seconds_ago: int) -> str:
        end = f"{seconds_ago} PRECEDING" if seconds_ago else "CURRENT ROW"
        return (
            f"coalesce(sum({column}) OVER (PARTITION BY {group} ORDER BY at_s "
            f"RANGE BETWEEN UNBOUNDED PRECEDING AND {end}), 0L)"
        )

    # Per feature its running totals, and how it comes from them.
    needed = {
        "tx_by_card_5m": (
            {"n_now": up_to("n", 0), "n_before_5m": up_to("n", VELOCITY_S + 1)},
            "CAST(n_now - n_before_5m AS INT)",
        ),
        "distinct_merchants_10m": (
            {
                "merchants_opened": up_to("merchant_opens", 0),
                "merchants_over": up_to("merchant_closes", MERCHANTS_S + 1),
            },
            "CAST(merchants_opened - merchants_over AS INT)",
        ),
        "distinct_countries_1h": (
            {
                "countries_opened": up_to("country_opens", 0),
                "countries_over": up_to("country_closes", COUNTRIES_S + 1),
            },
            "CAST(countries_opened - countries_over AS INT)",
        ),
        "declined_ratio_1h": (
            {
                "n_now": up_to("n", 0),
                "n_before_1h": up_to("n", DECLINED_S + 1),
                "declined_now": up_to("n_declined", 0),
                "declined_before_1h": up_to("n_declined", DECLINED_S + 1),
            },
            "round((declined_now - declined_before_1h) / (n_now - n_before_1h), 4)",
        ),
    }
    totals = {name: total for f in wanted for name, total in needed[f][0].items()}
    summed = per_time.selectExpr(*keep, *(f"{total} AS {name}" for name, total in totals.items()))
    return summed.selectExpr(*keep, *(f"{needed[f][1]} AS {f}" for f in wanted))


def _per_second(rows: DataFrame, wanted: list[str], own_slice: Column, next_slice: Column) -> DataFrame:
    """Totals of each card, day slice and second: payments, declines and run edges, as far as the
    wanted features need them. Payments are only multiplied by the kinds of value that are."""
    kinds = {
        what: value
        for feature, what, value in (
            ("distinct_merchants_10m", "merchant", "merchant_id"),
            ("distinct_countries_1h", "country", "country"),
        )
        if feature in wanted
    }
    counted = {"tx_by_card_5m", "declined_ratio_1h"} & set(wanted)
    at = epoch_second(F.col("event_time")).alias("at_s")
    slices = F.explode(F.array_distinct(F.array(own_slice, next_slice)))
    counts = [F.count(F.lit(1)).alias("n"), F.sum("d").alias("n_declined")]
    if not kinds:
        narrow = rows.select("card_id", at, declined().alias("d"))
        return narrow.groupBy("card_id", "at_s").agg(*counts).withColumn("slice", slices)

    sightings = [
        F.struct(F.lit(what).alias("what"), F.col(value).alias("value"))
        for what, value in kinds.items()
    ]
    if counted:
        nothing = F.lit(None).cast("string")
        sightings.insert(0, F.struct(F.lit("all").alias("what"), nothing.alias("value")))
    sighting = F.explode(F.array(*sightings)) if len(sightings) > 1 else sightings[0]
    narrow = rows.select("card_id", at, sighting.alias("s"), declined().alias("d"))
    per_value = (
        narrow.select("card_id", "at_s", "s.what", "s.value", "d")
        .groupBy("card_id", "what", "value", "at_s")
        .agg(*counts)
        .withColumn("slice", slices)
    )
    span = f"if(what = 'merchant', {MERCHANTS_S}, {COUNTRIES_S})"
    opens, closes = _run_edges("value", "card_id, slice, what", span)
    edges = per_value.withColumns({"opens": opens, "closes": closes})

    def total(column: str, what: str, name: str) -> Column:
        return F.sum(F.when(F.col("what") == what, F.col(column)).otherwise(F.lit(0))).alias(name)

    totals = [total(c, "all", c) for c in ("n", "n_declined") if counted]
    totals += [total(c, what, f"{what}_{c}") for what in kinds for c in ("opens", "closes")]
    return edges.groupBy("card_id", "slice", "at_s").agg(*totals)


def card_features(rows: DataFrame, wanted: Sequence[str] = tuple(CARD_FEATURES)) -> DataFrame:
    """Add the card features, or only the ``wanted`` ones, to deduplicated payments.

    The payments are first added up per card and second (and merchant or country), so what is left
    of a card is bounded by the seconds of the time span, not by its payments. These totals are cut
    into slices of a day; each slice also gets the last hour before it, so no frame is cut short,
    and no task holds more than a day of one card's seconds. The finished values go back to the
    payments by card and second: that key is not the windows', so both sides of the join are plain
    shuffles, which AQE can split when one second of one card is itself hot.
    """
    wanted = [f for f in CARD_FEATURES if f in wanted] if set(wanted) <= set(CARD_FEATURES) else []
    if not wanted:
        raise ValueError(f"wanted must name some of {CARD_FEATURES}")
    own_slice = F.floor(F.col("at_s") / SLICE_S)
    next_slice = F.floor((F.col("at_s") + LONGEST_S) / SLICE_S)
    per_second = _per_second(rows, wanted, own_slice, next_slice)
    ready = (
        _with_features(per_second, "card_id, slice", ["card_id", "at_s", "slice"], wanted)
        .filter(F.col("slice") == own_slice)
        .select(F.col("card_id").alias("key_card"), F.col("at_s").alias("key_at"), *wanted)
    )
    at = epoch_second(F.col("event_time"))
    match = F.col("card_id").eqNullSafe(F.col("key_card")) & (at == F.col("key_at"))
    return rows.join(ready, match, "left").select(*rows.columns, *wanted)
