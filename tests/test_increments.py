"""Stores that take in batches: equal to a run over everything, and untouched files stay."""

from __future__ import annotations

import functools
import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from payrisk.operators.device_sharing import cards_per_device
from payrisk.operators import component_store
from payrisk.plans import dashboard_store, gold, reports, silver, silver_store
from payrisk.plans.features import feature_rows
from payrisk.session import setting
from payrisk.sinks import aggregates, partitions, upsert
from tests.test_plans import plan_of

START = datetime(2024, 1, 1, 22, 0)


def files(path) -> dict[str, int]:
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def same(left, right) -> bool:
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


update = functools.partial(silver_store.update, buckets=4)

# Keyed upsert in buckets.


@pytest.fixture
def feature_table(event):
    rows = event(*[{"payment_id": f"P{i}", "amount": float(i)} for i in range(200)])
    return feature_rows(rows, F.lit("2024-01-02").cast("timestamp"))


def test_upsert_replaces_only_the_buckets_of_its_keys(spark, feature_table, tmp_path):
    path = str(tmp_path / "t")
    upsert.create_buckets(feature_table, path, buckets=16)
    before = files(path)
    batch = feature_table.filter("transaction_id in ('P3', 'P4')").withColumn("amount", F.lit(-1.0))
    new = feature_table.filter("transaction_id = 'P5'").withColumn("transaction_id", F.lit("NEW"))
    touched = upsert.upsert_buckets(spark, path, batch.unionByName(new))
    assert 1 <= len(touched) <= 3
    after = files(path)
    left = {name: time for name, time in before.items() if not any(f"={b}/" in name for b in touched)}
    assert left and left.items() <= after.items()
    assert not set(before) - set(left) & set(after)
    stored = upsert.read_buckets(spark, path)
    assert same(stored, upsert.upserted(feature_table, batch.unionByName(new)))
    assert stored.columns == feature_table.columns


def test_upsert_reads_only_the_buckets_of_its_keys(spark, feature_table, tmp_path):
    path = str(tmp_path / "t")
    upsert.create_buckets(feature_table, path, buckets=16)
    plan = plan_of(upsert.touched_rows(spark, path, [3, 5]))
    assert "PartitionFilters: [bucket_of_16" in plan and "IN (3,5)" in plan


def test_empty_batch_touches_nothing(spark, feature_table, tmp_path):
    path = str(tmp_path / "t")
    upsert.create_buckets(feature_table, path, buckets=4)
    before = files(path)
    assert upsert.upsert_buckets(spark, path, feature_table.limit(0)) == []
    assert files(path) == before
    with pytest.raises(ValueError, match="bucketed"):
        partitions.buckets_of(feature_table)


def test_rows_of_other_partitions_are_refused(spark, tmp_path):
    rows = spark.range(10).withColumn("p", (F.col("id") % 3).cast("int"))
    partitions.create(rows, str(tmp_path / "t"), "p")
    with pytest.raises(ValueError, match="not to be replaced"):
        partitions.replace(rows, str(tmp_path / "t"), "p", [0, 1])
    partitions.replace(rows.filter("p = 1 and id > 5"), str(tmp_path / "t"), "p", [0, 1])
    left = partitions.read(spark, str(tmp_path / "t"))
    assert sorted(r["id"] for r in left.collect()) == [2, 5, 7, 8]
    assert not (tmp_path / "t" / "p=0").exists()


# Sums.


def test_sums_add_up_and_vanish(spark, tmp_path):
    path = str(tmp_path / "s")

    def add(*rows):
        delta = spark.createDataFrame(list(rows), "k string, v long")
        changed = aggregates.add(spark, path, delta, ["k"], "v", buckets=4).collect()
        return {r["k"]: (r["before"], r["after"]) for r in changed}

    assert add(("a", 1), ("a", 2), (None, 5), ("zero", 0)) == {"a": (0, 3), None: (0, 5)}
    assert add(("a", -3), ("b", 4)) == {"a": (3, 0), "b": (0, 4)}
    assert add(("c", 0)) == {}
    stored = aggregates.read(spark, path, "k string, v long").collect()
    assert sorted((str(r["k"]), r["v"]) for r in stored) == [("None", 5), ("b", 4)]
    assert aggregates.read(spark, str(tmp_path / "none"), "k string, v long").count() == 0


# Silver by day.


def _feed(seed: int, n: int) -> list[dict]:
    """Payments over four days, many around midnight; a device in a third of all rows; copies."""
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        moment = START + timedelta(days=pick.randrange(4), seconds=pick.randrange(4 * 3600))
        rows.append(
            {
                "payment_id": f"P{pick.randrange(int(n * 0.8))}",
                "event_time": moment.isoformat(),
                "card_id": pick.choice([None, "A", "B", "C", f"c{i % 40}"]),
                "merchant_id": pick.choice([None, "m1", "m2", "m3"]),
                "country": pick.choice(["ES", "FR", None]),
                "device_id": "HOT" if i % 3 == 0 else pick.choice([None, "D", "E"]),
                "status": pick.choice(["approved", "declined"]),
            }
        )
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_increments_equal_the_whole(spark, event, tmp_path, seed):
    """Any cut into increments, with copies of a payment in several of them."""
    feed = _feed(seed, 160)
    cuts = [feed[:100], feed[100:], feed[:20]]
    root = str(tmp_path / "store")
    for part in cuts:
        change = update(spark, root, event(*part))
    assert change.days == [] and change.devices.count() == 0  # nothing new in the last one
    whole = silver.silver(event(*feed))
    stored = silver_store.silver(spark, root)
    assert same(stored.drop("day"), whole)
    counts = cards_per_device(silver.deduplicated(event(*feed))).filter("distinct_cards_per_device > 0")
    kept = silver_store.devices(spark, root)
    assert same(kept.selectExpr("device_id", "cast(n_cards as int)"), counts)
    before = set(map(tuple, kept.collect()))
    silver_store.recount(spark, root, 4)
    assert set(map(tuple, silver_store.devices(spark, root).collect())) == before


def test_only_reached_days_are_rewritten(spark, event, tmp_path):
    root = tmp_path / "store"
    rows = [{"event_time": f"2024-01-0{d}T12:00:00", "payment_id": f"{d}{i}"} for d in range(1, 6) for i in "ab"]
    update(spark, str(root), event(*rows))
    before = files(root / "rows")
    noon = update(spark, str(root), event({"event_time": "2024-01-02T12:01:00", "payment_id": "x"}))
    night = update(spark, str(root), event({"event_time": "2024-01-03T23:30:00", "payment_id": "y"}))
    day = noon.days[0]
    assert (noon.days, night.days) == ([day], [day + 1, day + 2])
    after = files(root / "rows")
    for name, time in before.items():
        reached = any(f"day={d}/" in name for d in (day, day + 1, day + 2))
        assert reached != (after.get(name) == time)


def test_an_earlier_copy_moves_a_payment_to_another_day(spark, event, tmp_path):
    """Its old day loses it, a day without payments loses its folder, its device a card."""
    root = tmp_path / "store"
    old = {"payment_id": "moved", "event_time": "2024-01-05T10:00:00", "card_id": "old", "device_id": "D"}
    rest = {"payment_id": "stays", "event_time": "2024-01-02T10:00:00", "card_id": "c", "device_id": "D"}
    update(spark, str(root), event(old, rest))
    new = {**old, "event_time": "2024-01-02T10:00:30", "card_id": "c"}
    change = update(spark, str(root), event(new))
    assert len(change.days) == 2
    assert same(silver_store.silver(spark, str(root)).drop("day"), silver.silver(event(new, rest)))
    assert [tuple(r) for r in change.devices.collect()] == [("D", 2, 1)]
    assert len(list((root / "rows").glob("day=*"))) == 1


def test_device_counts_change_only_for_touched_devices(spark, event, tmp_path):
    root = str(tmp_path / "store")
    hot = [{"payment_id": f"h{i}", "device_id": "HOT", "card_id": f"c{i % 9}"} for i in range(60)]
    rest = [{"payment_id": f"r{i}", "device_id": f"D{i % 30}", "card_id": f"c{i % 4}"} for i in range(120)]
    update(spark, root, event(*hot, *rest))
    before = files(f"{root}/devices")
    known = update(spark, root, event({"payment_id": "k", "device_id": "HOT", "card_id": "c1"}))
    assert known.devices.count() == 0 and files(f"{root}/devices") == before
    more = update(spark, root, event({"payment_id": "n", "device_id": "HOT", "card_id": "new"}))
    assert [tuple(r) for r in more.devices.collect()] == [("HOT", 9, 10)]
    after = files(f"{root}/devices")
    assert len(set(before.items()) - set(after.items())) == 1


def test_empty_increments(spark, event, tmp_path):
    root = str(tmp_path / "store")
    assert update(spark, root, event({}).limit(0)).days == []
    update(spark, root, event({"card_id": None, "device_id": None}))
    assert update(spark, root, event({"event_time": "?"})).days == []
    assert silver_store.silver(spark, root).first()["distinct_cards_per_device"] == 0


def test_an_increment_reads_ids_and_reached_days_only(spark, event, tmp_path):
    root = str(tmp_path / "store")
    update(spark, root, event(*_feed(4, 60)))
    plan = plan_of(silver_store.silver(spark, root, [19723]))
    assert "PartitionFilters: [isnotnull(day" in plan or "PartitionFilters: [(day" in plan
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        ids = plan_of(partitions.read(spark, f"{root}/rows").select("payment_id", "day"))
    assert "ReadSchema: struct<payment_id:string>" in ids


# Dashboards from partials.


def test_dashboards_follow_the_store(spark, event, tmp_path):
    """Partials after three increments are those of everything at once, also on days that only a
    device's new cards have changed."""
    root, path = str(tmp_path / "store"), str(tmp_path / "partials")
    feed = _feed(9, 120)
    # A device that goes over the rule's four cards on the last day, and was used on the first.
    quiet = [
        {"payment_id": f"q{i}", "event_time": f"2024-01-{10 + 5 * (i > 2)}T12:0{i}:00", "card_id": f"q{i}", "device_id": "Q"}
        for i in range(4)
    ]
    days = []
    for part in (feed[:80] + quiet[:3], feed[80:], quiet[3:]):
        days.append(dashboard_store.follow(spark, path, root, update(spark, root, event(*part))))
    assert len(days[2]) == 2  # the payment's day, and the day of its device
    relations = gold.relations(silver.silver(event(*feed, *quiet)))
    stored = dashboard_store.read(spark, path)
    assert same(stored.select(sorted(stored.columns)), whole_partials(relations, stored))
    assert same(dashboard_store.totals(stored), reports.totals(relations))
    assert same(dashboard_store.timeline(stored), reports.timeline(relations))
    assert same(dashboard_store.timeline(stored, "1 day"), reports.timeline(relations, "1 day"))
    for kind, column in (("merchant", "merchant_id"), ("card", "card_id")):
        top = dashboard_store.top_risk(stored, kind)
        assert top.collect() == reports.top_risk(relations, column).collect()
    scored = relations.withColumn("puntuacion_riesgo", F.col("risk_score"))
    assert same(dashboard_store.activity(stored, "card"), reports.activity(scored, "card_id"))


def whole_partials(relations, like):
    return dashboard_store.partials(relations).select(sorted(like.columns))


def test_days_without_change_keep_their_partials(spark, event, tmp_path):
    root, path = str(tmp_path / "store"), tmp_path / "partials"
    first = [{"payment_id": f"{d}", "event_time": f"2024-01-0{d}T12:00:00", "device_id": f"D{d}"} for d in range(1, 5)]
    dashboard_store.follow(spark, str(path), root, update(spark, root, event(*first)))
    before = files(path)
    change = update(spark, root, event({"payment_id": "n", "event_time": "2024-01-03T12:30:00", "device_id": "N"}))
    assert dashboard_store.follow(spark, str(path), root, change) == change.days
    after = files(path)
    assert len(set(before.items()) & set(after.items())) == 3
    assert dashboard_store.follow(spark, str(path), root, update(spark, root, event(*first))) == []


def test_dashboards_read_partials_only(spark, event, tmp_path):
    path = str(tmp_path / "partials")
    dashboard_store.refresh(spark, path, gold.relations(silver.silver(event({}))), [])
    plan = plan_of(dashboard_store.top_risk(dashboard_store.read(spark, path), "merchant"))
    assert "TakeOrderedAndProject" in plan and "payment_id" not in plan
    assert "EqualTo(kind,merchant)" in plan and "amount_sum" not in plan


# Components.


def _plain_components(links):
    name = {x: x for link in links for x in link}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(name[a], name[b])
            for x in (a, b):
                if name[x] != low:
                    name[x], changed = low, True
    return name


@pytest.mark.parametrize("seed", [1, 2])
def test_links_in_batches_equal_all_at_once(spark, tmp_path, seed):
    """Chains, a hub with a third of all links, merges of old components, repeated links."""
    pick = random.Random(seed)
    links = [(f"n{pick.randrange(90):02d}", f"n{pick.randrange(90):02d}") for _ in range(60)]
    links += [("hub", f"n{pick.randrange(90):02d}") for _ in range(30)]
    links = [(a, b) for a, b in links if a != b]
    path = str(tmp_path / "c")
    for at in range(0, len(links), 30):
        batch = [*links[at : at + 30], *links[:2], ("n01", "n01"), (None, "n02")]
        component_store.add_links(spark, path, spark.createDataFrame(batch, "a string, b string"), 4)
        known = _plain_components(links[: at + 30])
        assert {r["node"]: r["component"] for r in component_store.read(spark, path).collect()} == known
    again = component_store.add_links(spark, path, spark.createDataFrame(links, "a string, b string"), 4)
    assert again.count() == 0


def test_only_buckets_of_renamed_nodes_are_rewritten(spark, tmp_path):
    path = tmp_path / "c"
    links = [(f"a{i:02d}", f"b{i:02d}") for i in range(60)]
    component_store.add_links(spark, str(path), spark.createDataFrame(links, "a string, b string"), 16)
    before = files(path)
    more = spark.createDataFrame([("a07", "b03")], "a string, b string")
    changed = component_store.add_links(spark, str(path), more, 16)
    assert sorted(map(tuple, changed.collect())) == [("a07", "a03"), ("b07", "a03")]
    left = set(before.items()) & set(files(path).items())
    assert len(left) >= len(before) - 2


def test_only_roots_are_contracted(spark, tmp_path, monkeypatch):
    """What goes into the contraction are links between roots: new ones only, none of the old."""
    path = str(tmp_path / "c")
    chain = spark.createDataFrame([(f"n{i:03d}", f"n{i + 1:03d}") for i in range(100)], "a string, b string")
    component_store.add_links(spark, path, chain, 4)
    seen = []
    contract = component_store.connected_components
    monkeypatch.setattr(
        component_store, "connected_components", lambda pairs: (seen.append(sorted(map(tuple, pairs.collect()))), contract(pairs))[1]
    )
    more = spark.createDataFrame([("n050", "x"), ("n070", "n003"), ("y", "z")], "a string, b string")
    component_store.add_links(spark, path, more, 4)
    assert seen == [[("x", "n000"), ("z", "y")]]
    empty = component_store.add_links(spark, str(tmp_path / "none"), more.limit(0), 4)
    assert empty.count() == 0 and component_store.read(spark, str(tmp_path / "none")).count() == 0
