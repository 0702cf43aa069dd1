"""Every query against its SQL on a second engine, and the recorded golden values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from payrisk import fixtures
from payrisk.catalog import QUERIES
from payrisk.operators.cleaning import clean_payments
from payrisk.oracle import ORACLE
from payrisk.plans import gold, graph, reports, silver, textset
from payrisk.plans.insights import as_report, with_native_score
from payrisk.session import stage
from tests.conftest import SF, SF_NEXT

TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def _ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_query_has_sql_and_is_registered():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLE) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF)
    expected = duck.sql(ORACLE[name])
    columns = sorted(result.columns)
    assert columns == sorted(expected.columns)
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: TYPES[t] for c, t in result.dtypes} == types
    position = [expected.columns.index(c) for c in columns]
    got = _ordered(tuple(r[c] for c in columns) for r in result.collect())
    want = _ordered(tuple(r[i] for i in position) for r in expected.fetchall())
    assert got == want


def test_entry_and_classifier(spark):
    assert entry_module.entry(spark).count() == 128
    relations = stage(gold.relations(silver.silver(fixtures.payments(spark, SF))), "entry")
    report = as_report(with_native_score(relations).withColumn("device_type", F.col("device_id")))
    training, validation = textset.split(stage(textset.text_set(report, keep_id=True), "texts"))
    assert validation.count() == 950 - 759
    assert textset.accuracy(textset.train(training), validation) > 0.9


@pytest.mark.parametrize(
    ("folder", "events", "golden"),
    [
        (SF, 1_000, (950, 128, 2178, 3205, 1575, 992, 199.0711, 11616, 60)),
        (SF_NEXT, 10_000, (9500, 2064, 22014, 31806, 17840, 20190, 1920.9564, 144986, 76)),
    ],
)
def test_golden_features_and_scores(spark, folder, events, golden):
    feed = fixtures.payments(spark, folder)
    assert feed.count() == events
    row = (
        gold.relations(silver.silver(feed))
        .agg(
            F.count("*"),
            F.count_if(F.col("risk_score") >= 20),
            F.sum("tx_by_card_5m"),
            F.sum("distinct_merchants_10m"),
            F.sum("distinct_countries_1h"),
            F.sum("distinct_cards_per_device"),
            F.round(F.sum("declined_ratio_1h"), 4),
            F.sum("risk_score"),
            F.max("risk_score"),
        )
        .first()
    )
    assert tuple(row) == golden


def test_golden_reports_graph_and_cleaning(spark):
    relations = stage(gold.relations(silver.silver(fixtures.payments(spark, SF_NEXT))), "golden")
    assert relations.filter("amount >= 1200").count() == 834
    report = as_report(with_native_score(relations).withColumn("device_type", F.col("device_id")))
    geo = {r["country"]: (r["volumen"], r["tasa_fraude_pct"]) for r in reports.geo_patterns(report).collect()}
    assert geo == {"DE": (203, 16.26), "ES": (8885, 20.23), "FR": (207, 23.67), "US": (205, 22.44)}
    first = reports.high_risk(report).first()
    assert (first["payment_id"], first["puntuacion_riesgo"]) == ("PAY-9480", 28)
    top = reports.activity(report).agg(
        F.count("*"), F.sum("alertas_confirmadas"), F.max("max_puntuacion")
    )
    assert tuple(top.first()) == (150, 1925, 76)
    kinds = {r["kind"]: r["count"] for r in graph.nodes(relations).groupBy("kind").count().collect()}
    assert kinds == {"customer": 150, "card": 50, "device": 54, "merchant": 20, "payment": 9500}
    assert graph.shared_devices(relations).count() == 4
    assert graph.multi_country_cards(relations).count() == 50
    assert graph.anomaly_components(relations).select("component").distinct().count() == 4
    rows = textset.text_set(report, keep_id=True)
    assert rows.filter("label = 1").count() == 6602
    assert textset.split(rows)[0].count() == 7625
    cleaned = clean_payments(fixtures.payments_dirty(spark, SF_NEXT), ["event_id"])
    countries = {r["country"]: r["count"] for r in cleaned.groupBy("country").count().collect()}
    assert countries == {"ES": 6110, "FR": 1799, None: 853}
