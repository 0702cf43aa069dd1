from __future__ import annotations

from payrisk.operators.cleaning import clean_features, clean_payments, normalize
from payrisk.operators.fusion import fuse, suspicious
from payrisk.plans.insights import as_report, insights_report
from payrisk.schemas import REPORT


def _one(spark, schema, *values):
    return normalize(spark.createDataFrame([values], schema)).first()


def test_field_rules(spark):
    row = _one(
        spark,
        "payment_id string, card_id string, amount string, event_time string, country string, status string, other string",
        "  PAY-1\t\n", " card-9 ", " 12.5 ", "2024-01-01T00:00:00Z", " España ", " Declined\n", " kept ",
    )
    assert (row["payment_id"], row["card_id"], row["amount"], row["country"], row["status"], row["other"]) == (
        "PAY-1", "CARD-9", 12.5, "ES", "declined", " kept ",
    )
    assert str(row["event_time"]) == "2024-01-01 00:00:00"


def test_countries(spark):
    rows = spark.createDataFrame([(c,) for c in ["es", "SPAIN", "unknown", None, "fr", "nan"]], "country string")
    assert [r["country"] for r in normalize(rows).collect()] == ["ES", "ES", None, None, "FR", "NAN"]


def test_amounts_that_are_no_numbers(spark):
    texts = ["1", "-2.5", "1e3", "abc", "", None, "nan", "1.5d", "2f"]
    rows = spark.createDataFrame([(t,) for t in texts], "amount string")
    got = [r["amount"] for r in normalize(rows).collect()]
    assert got == [1.0, -2.5, 1000.0, None, None, None, None, None, None]


def test_times_of_mixed_precision(spark):
    texts = ["2024-01-01T00:00:00", "2024-01-01T00:00:00.123456", "2024-01-01 00:00:00.1", "nope"]
    rows = spark.createDataFrame([(t,) for t in texts], "event_time string")
    assert [r["event_time"] is None for r in normalize(rows).collect()] == [False, False, False, True]


def test_duplicates_go_before_unusable_rows(spark):
    rows = spark.createDataFrame(
        [(1, "A", None, 5.0), (2, " A ", "k", 5.0), (3, "B", "k", 0.0), (4, "C", "k", 1.0), (5, "D", "k", None)],
        "seq int, payment_id string, card_id string, amount double",
    )
    assert [r["payment_id"] for r in clean_payments(rows, ["seq"]).collect()] == ["C"]


def test_feature_names(spark):
    rows = spark.createDataFrame([(" T ", "U", 1), ("T", "V", 2)], "transaction_id string, user_id string, seq int")
    assert [tuple(r) for r in clean_features(rows, ["seq"]).collect()] == [("T", "U", 1)]


GOLD = (
    "payment_id string, status string, country string, tx_by_card_5m int, distinct_merchants_10m int, "
    "distinct_countries_1h int, declined_ratio_1h double"
)


def test_join_keeps_common_payments_and_fills_zeros(spark):
    gold = spark.createDataFrame([("A", "approved", "ES", None, None, None, None), ("B", "approved", "ES", 1, 1, 1, 0.0)], GOLD)
    features = spark.createDataFrame([("A", "D1", 0.9), ("Z", "D2", 0.9)], "payment_id string, device_type string, risk_score double")
    rows = fuse(gold, features).collect()
    assert len(rows) == 1
    # Without a native score the score is 0; the feature table's own score is not taken.
    assert (rows[0]["device_type"], rows[0]["risk_score"], rows[0]["tx_by_card_5m"]) == ("D1", 0.0, 0)
    assert fuse(gold, features.select("payment_id")).columns[-1] == "risk_score"


def test_suspicion(spark):
    cases = {
        "score": ("approved", "ES", 1, 11), "declined": ("declined", "ES", 1, 0),
        "frequent": ("approved", "ES", 2, 0), "foreign": ("approved", "FR", 1, 0),
        "nowhere": ("approved", None, 1, 0), "fine": ("approved", "ES", 1, 10), "no status": (None, "ES", 1, 0),
    }
    rows = spark.createDataFrame(
        [(k, *v) for k, v in cases.items()], "payment_id string, status string, country string, tx_by_card_5m int, risk_score int"
    )
    assert {r["payment_id"] for r in suspicious(rows).collect()} == set(cases) - {"fine", "no status"}


def test_report_shape(spark, event):
    from payrisk.plans import gold, silver
    from payrisk.plans.features import feature_rows

    table = silver.silver(event({"status": "declined"}, {"country": "ES"}))
    report = insights_report(gold.relations(table, keep_reasons=True), feature_rows(table))
    assert report.schema.simpleString() == REPORT.simpleString()
    row = report.filter("payment_id = 'PAY-0'").first()
    assert (row["device_type"], row["reasons"], row["reasons_text"]) == ("DEV-1", "high_declined_ratio_1h", "high_declined_ratio_1h")
    assert as_report(table).filter("puntuacion_riesgo IS NOT NULL").count() == 0
