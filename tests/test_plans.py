"""Properties of the plans that decide how they scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from payrisk import catalog, fixtures
from payrisk.plans import gold, reports, silver
from payrisk.plans.features import feature_rows
from payrisk.operators.fusion import fuse
from payrisk.plans.insights import as_report, fused_payments, store_sides, with_native_score
from payrisk.session import setting, stage
from payrisk.sinks.tables import drop_table
from tests.conftest import SF

LAZY = [
    "bronze_parse", "publish_json", "silver", "relations", "alerts", "clean", "features_map", "suspicious",
    "customer_activity", "graph_nodes", "graph_edges", "nlp_dataset", "train_val_split", "top_risk_merchants",
]


def plan_of(df, executed=False):
    if executed:
        df.write.format("noop").mode("overwrite").save()
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_nested_loops(spark, name):
    plan = plan_of(catalog.QUERIES[name](spark, SF))
    for node in ("Python", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_silver_joins_back_over_plain_shuffles(spark):
    """Both sides of the join by card and second are exchanges that AQE may split."""
    feed = stage(fixtures.payments(spark, SF), "feed")
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        plan = plan_of(silver.silver(feed))
    exchanges = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    back = [line for line in exchanges if "isnull(card_id" in line or "isnull(key_card" in line]
    assert len(back) == 2 and all("ENSURE_REQUIREMENTS" in line for line in back)
    assert not [x for x in exchanges if re.search(r"hashpartitioning\(card_id#\d+, \d+\)", x)]
    assert "lag(at_s" in plan and "collect_set" not in plan and "collect_list" not in plan


def test_copies_of_a_payment_are_cut_before_the_shuffle(spark):
    feed = stage(fixtures.payments(spark, SF), "feed")
    plan = plan_of(silver.deduplicated(feed))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_deduplication_runs_once_for_all_features(spark):
    feed = stage(fixtures.payments(spark, SF), "feed")
    assert "WindowGroupLimit" not in plan_of(silver.silver(feed))


def test_fusion_does_not_sort_unique_tables_again(spark):
    relations = stage(gold.relations(silver.silver(fixtures.payments(spark, SF))), "relations")
    loaded = stage(feature_rows(relations), "loaded")
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        plan = plan_of(fused_payments(relations, loaded))
        again = plan_of(fused_payments(relations, loaded, unique=False))
    assert plan.count("Exchange hashpartitioning") == 2 and "Window" not in plan
    assert "WindowGroupLimit" in again


def test_filters_and_columns_reach_the_scan(spark):
    relations = stage(gold.relations(silver.silver(fixtures.payments(spark, SF))), "relations")
    sliced = gold.time_slice(relations, "2024-01-01 01:00:00", "2024-01-01 03:00:00").select("payment_id")
    plan = plan_of(sliced)
    assert "GreaterThanOrEqual(event_time" in plan and "LessThan(event_time" in plan
    assert "ReadSchema: struct<event_time:timestamp,payment_id:string>" in plan
    high = plan_of(relations.filter(F.col("risk_score") >= 20))
    assert "GreaterThanOrEqual(risk_score,20)" in high


def test_top_rows_are_not_sorted_whole(spark):
    assert "TakeOrderedAndProject" in plan_of(catalog.QUERIES["top_risk_cards"](spark, SF))
    relations = gold.relations(silver.silver(fixtures.payments(spark, SF)))
    assert "TakeOrderedAndProject" in plan_of(reports.high_risk(as_report(with_native_score(relations))))


def test_export_folders_prune(spark, event, tmp_path):
    from payrisk.sinks import exports

    rows = event({}, {"event_time": "2024-01-02T00:00:00"})
    exports.export_by_time(rows, str(tmp_path / "e"), "day")
    stored = exports.read_export(spark, str(tmp_path / "e"), rows.schema, "day")
    assert "PartitionFilters: [isnotnull(day" in plan_of(stored.filter("day = '02'"))


def test_single_features_do_only_their_part(spark):
    """Payments are multiplied only by the kinds of value that a feature needs."""
    feed = stage(fixtures.payments(spark, SF), "feed")
    counts = plan_of(silver.card_behaviour(feed, ["tx_by_card_5m", "declined_ratio_1h"]))
    assert "lag(" not in counts and "explode(array(struct" not in counts and "merchant AS" not in counts
    merchants = plan_of(silver.card_behaviour(feed, ["distinct_merchants_10m"]))
    assert "lag(" in merchants and "country AS value" not in merchants
    whole = plan_of(silver.card_behaviour(feed))
    assert whole.count("Generate") > merchants.count("Generate") == counts.count("Generate")


def test_fusion_of_bucketed_tables_moves_no_row(spark):
    relations = stage(gold.relations(silver.silver(fixtures.payments(spark, SF))), "relations")
    loaded = stage(feature_rows(relations), "loaded")
    sides = store_sides(relations, loaded, ("fusion_gold", "fusion_features"), 4)
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        plan = plan_of(fuse(*sides))
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
        assert fuse(*sides).exceptAll(fused_payments(relations, loaded)).count() == 0
        assert fuse(*sides).count() == fused_payments(relations, loaded).count() > 0
    for name in ("fusion_gold", "fusion_features"):
        drop_table(spark, name)
