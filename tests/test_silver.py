"""Typing, deduplication and window features on hand-written and random rows."""

from __future__ import annotations

import random
import re
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from payrisk.operators import card_windows
from payrisk.plans import silver
from payrisk.schemas import FEATURE_COLUMNS, SILVER_COLUMNS

START = datetime(2024, 1, 1, 23, 30)


def _features(df, *names):
    return {r["payment_id"]: tuple(r[n] for n in names) for r in df.collect()}


def test_frame_bounds_and_peers_of_a_second(event):
    times = ["00:00:00.1", "00:00:00.9", "00:05:00.5", "00:05:01.0"]
    rows = event(*[{"event_time": f"2024-01-01T{t}"} for t in times])
    got = _features(silver.silver(rows), "tx_by_card_5m")
    assert [got[f"PAY-{i}"][0] for i in range(4)] == [2, 2, 3, 2]


def test_unusable_rows_and_duplicates_go(event):
    rows = event(
        {"event_time": "nope"},
        {"event_time": None},
        {"payment_id": None},
        {"payment_id": "A", "event_time": "2024-01-01T00:00:02", "amount": 2.0},
        {"payment_id": "A", "event_time": "2024-01-01T00:00:01Z", "amount": 1.0},
    )
    kept = silver.silver(rows).collect()
    assert [(r["payment_id"], r["amount"]) for r in kept] == [("A", 1.0)]


def test_deduplication_does_not_depend_on_partitioning(spark, event):
    rows = event(*[{"payment_id": "A", "amount": float(i % 7)} for i in range(50)])
    survivors = {
        silver.deduplicated(rows.repartition(n)).first()["amount"] for n in (1, 3, 16)
    }
    assert survivors == {0.0}


def test_nulls(event):
    rows = event(
        {"merchant_id": None, "status": None},
        {"merchant_id": "M", "status": "declined"},
        {"card_id": None, "country": None, "device_id": None},
        {"card_id": None, "country": "FR", "device_id": None},
    )
    got = _features(silver.silver(rows), *FEATURE_COLUMNS)
    assert got["PAY-0"] == (2, 1, 1, 1, 0.5)
    # Payments without a card count as one card's in the windows, and as no card on the device.
    assert got["PAY-2"] == (2, 1, 1, 0, 0.0)


def _random_feed(seed: int, rows: int) -> list[dict]:
    pick = random.Random(seed)
    feed = []
    for _ in range(rows):
        hot = pick.random() < 0.4
        moment = START + timedelta(seconds=pick.choice([0, 1, 299, 300, 301, 600, 601]) + pick.randrange(9000))
        feed.append(
            {
                "event_time": moment.isoformat(),
                "card_id": "HOT" if hot else pick.choice([None, "A", "B", "C"]),
                "merchant_id": pick.choice([None, "m1", "m2", "m3", "m4"]),
                "country": pick.choice([None, "ES", "FR", "US"]),
                "device_id": "D" if pick.random() < 0.5 else pick.choice([None, "E", "F"]),
                "status": pick.choice([None, "approved", "declined"]),
            }
        )
    return feed


def _brute_force(feed: list[dict]) -> dict[str, tuple]:
    at = [int(datetime.fromisoformat(r["event_time"]).timestamp()) for r in feed]

    def frame(i, seconds):
        return [
            r
            for j, r in enumerate(feed)
            if r["card_id"] == feed[i]["card_id"] and 0 <= at[i] - at[j] <= seconds
        ]

    result = {}
    for i, row in enumerate(feed):
        hour = frame(i, 3600)
        same_device = [r for r in feed if r["device_id"] == row["device_id"]]
        result[f"PAY-{i}"] = (
            len(frame(i, 300)),
            len({r["merchant_id"] for r in frame(i, 600)} - {None}),
            len({r["country"] for r in hour} - {None}),
            len({r["card_id"] for r in same_device} - {None}),
            round(sum(r["status"] == "declined" for r in hour) / len(hour) + 1e-12, 4),
        )
    return result


@pytest.mark.parametrize("seed", [1, 2])
def test_features_equal_brute_force(event, seed):
    """The feed crosses midnight, where a card's totals are cut into slices."""
    feed = _random_feed(seed, 300)
    got = _features(silver.silver(event(*feed)), *FEATURE_COLUMNS)
    assert got == _brute_force(feed)


def test_one_second_holds_most_payments_of_a_card_over_several_days(event):
    """A null card, a card with a hot second, and a card whose payments span days."""
    pick = random.Random(4)
    feed = [
        {"event_time": START.isoformat(), "card_id": card, "merchant_id": f"m{i % 7}"}
        for i in range(120)
        for card in ("HOT", None)
    ]
    feed += [
        {
            "event_time": (START + timedelta(seconds=pick.randrange(4 * 86_400))).isoformat(),
            "card_id": pick.choice(["HOT", "LONG", None]),
            "status": pick.choice(["approved", "declined"]),
        }
        for _ in range(80)
    ]
    defaults = {"merchant_id": "MERCH-1", "country": "ES", "device_id": "DEV-1", "status": "approved"}
    full = [{**defaults, **row} for row in feed]
    got = _features(silver.silver(event(*feed)), *FEATURE_COLUMNS)
    assert got == _brute_force(full)


def test_plan_has_no_window_over_a_whole_card(event):
    plan = silver.silver(event({}))._jdf.queryExecution().optimizedPlan().toString()
    windows = re.findall(r"Window \[[^\n]*", plan)
    assert windows
    for line in windows:
        keys = line.split("], [")[1]
        assert "slice" in keys and "card_id" in keys
    source = Path(silver.__file__).parents[1]
    for path in source.rglob("*.py"):
        # partitions.py lists the partitions that a batch touches, jdbc.py counts of some cells.
        listed = ("components.py", "partitions.py", "jdbc.py")
        if "llm" not in path.parts and path.name not in listed:
            assert not re.search(r"\.collect\(|repartition\(\"card_id", path.read_text()), path


def test_silver_contract(event):
    table = silver.silver(event({}))
    assert table.columns == SILVER_COLUMNS
    assert dict(table.dtypes)["tx_by_card_5m"] == "int"
    assert dict(table.dtypes)["event_time"] == "timestamp"


def test_card_behaviour_is_the_card_part_of_silver(event):
    rows = event(*_random_feed(5, 80))
    names = [n for n in FEATURE_COLUMNS if n != "distinct_cards_per_device"]
    want = _features(silver.silver(rows), *names)
    assert _features(silver.card_behaviour(rows), *names) == want


@pytest.mark.parametrize("name", card_windows.CARD_FEATURES)
def test_single_features_equal_all(event, name):
    rows = event(*_random_feed(6, 120))
    assert _features(silver.card_behaviour(rows, [name]), name) == _features(silver.silver(rows), name)


def test_unknown_feature(event):
    with pytest.raises(ValueError, match="wanted"):
        silver.card_behaviour(event({}), ["tx_by_card_5m", "nothing"])
