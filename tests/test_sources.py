from __future__ import annotations

import json

import pytest

from payrisk.schemas import EVENT, REPORT
from payrisk.sinks.tables import write_csv
from payrisk.sources.tables import (
    EmptySource,
    external_csv_table,
    jdbc_options,
    read_csv,
    read_json,
    read_mixed,
    require_rows,
)


def _object(payment_id):
    return {"payment_id": payment_id, "amount": 2.5, "ip": "1.1.1.1"}


def test_arrays_single_objects_and_csv_below_one_prefix(spark, tmp_path):
    deep = tmp_path / "gold" / "year=2024" / "month=01"
    deep.mkdir(parents=True)
    (deep / "a.json").write_text(json.dumps([_object("A"), _object("B")], indent=1))
    (tmp_path / "gold" / "one.json").write_text(json.dumps(_object("C")))
    (deep / "skipped.txt").write_text("payment_id\nX\n")
    (deep / "b.csv").write_text('payment_id,amount\n"D, d",1.5\n')
    csv_schema = type(EVENT)([EVENT["payment_id"], EVENT["amount"]])
    rows = read_mixed(spark, str(tmp_path / "gold"), EVENT, csv_schema, whole_files=True)
    assert rows.columns == EVENT.names
    got = {(r["payment_id"], r["amount"], r["ip"]) for r in rows.collect()}
    assert got == {("A", 2.5, "1.1.1.1"), ("B", 2.5, "1.1.1.1"), ("C", 2.5, "1.1.1.1"), ("D, d", 1.5, None)}


def test_json_lines_are_the_default(spark, tmp_path):
    (tmp_path / "x.json").write_text("\n".join(json.dumps(_object(i)) for i in "AB"))
    assert read_json(spark, str(tmp_path), EVENT).count() == 2


def test_csv_header_must_fit_the_schema(spark, tmp_path):
    (tmp_path / "x.csv").write_text("amount,payment_id\n1.5,A\n")
    csv_schema = type(EVENT)([EVENT["payment_id"], EVENT["amount"]])
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path), csv_schema).collect()


def test_external_table_keeps_commas_and_quotes(spark, event, tmp_path):
    from payrisk.plans import gold, silver
    from payrisk.plans.insights import as_report, with_native_score

    relations = gold.relations(silver.silver(event({"amount": 5000.0, "merchant_id": 'a "b", c'})))
    path = str(tmp_path / "report")
    write_csv(as_report(with_native_score(relations)), path)
    for _ in range(2):  # the second call recreates the table
        table = external_csv_table(spark, "insights_report_test", path, REPORT)
    assert table.columns == REPORT.names
    row = table.first()
    assert (row["merchant_id"], row["reasons_text"], row["risk_score"]) == ('a "b", c', "high_amount", 12.0)


def test_empty_input_stops_the_job(spark, event):
    rows = event({})
    assert require_rows(rows, "silver") is rows
    with pytest.raises(EmptySource, match="silver"):
        require_rows(rows.limit(0), "silver")


def test_parallel_database_read_options():
    plain = jdbc_options("jdbc:x", "fraud_features", user="u")
    assert plain["dbtable"] == "fraud_features" and plain["user"] == "u"
    ranged = jdbc_options("jdbc:x", "t", "event_time", ("2024-01-01", "2024-02-01"), 64)
    assert (ranged["partitionColumn"], ranged["numPartitions"]) == ("event_time", "64")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", "event_time")
