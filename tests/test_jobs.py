"""The whole pipeline as jobs, from a bronze table to the trained model."""

from __future__ import annotations

import pytest

from payrisk import fixtures, jobs
from payrisk.plans import silver_store
from payrisk.schemas import REPORT
from payrisk.sinks.tables import create_namespace, replace_table
from payrisk.sources.tables import EmptySource, read_csv
from tests.conftest import SF


def test_pipeline_from_bronze_to_model(spark, tmp_path, capsys):
    create_namespace(spark, "jobs_ns")
    replace_table(fixtures.payments(spark, SF), "jobs_ns.bronze")

    def run(job, **parameters):
        words = [w for k, v in parameters.items() for w in (f"--{k.replace('_', '-')}", str(v))]
        jobs.main([job, *words], spark)

    run("silver-table", source="jobs_ns.bronze", target="jobs_ns.silver")
    run(
        "gold-tables", source="jobs_ns.silver", relations="jobs_ns.relations", alerts="jobs_ns.alerts",
        keep_reasons="yes",
    )
    assert "jobs_ns.relations: 950 rows" in capsys.readouterr().out
    assert spark.read.table("jobs_ns.alerts").filter("size(reasons) = 0").count() == 0
    assert spark.read.table("jobs_ns.relations").count() == 950
    assert spark.read.table("jobs_ns.alerts").count() == 128

    run("export", source="jobs_ns.alerts", path=tmp_path / "gold")
    assert spark.read.json(str(tmp_path / "gold")).count() == 128

    run("features", source="jobs_ns.silver", new_path=tmp_path / "f1")
    run("features", source="jobs_ns.silver", target_path=tmp_path / "f1", new_path=tmp_path / "f2")
    assert spark.read.parquet(str(tmp_path / "f2")).count() == 950

    run("insights", relations="jobs_ns.relations", features_path=tmp_path / "f2", path=tmp_path / "report")
    run(
        "fusion-tables", relations="jobs_ns.relations", features_path=tmp_path / "f2", cleaned="jobs_ns.cleaned",
        features="jobs_ns.features", buckets=4,
    )
    run("insights", relations="jobs_ns.cleaned", features_path="jobs_ns.features", path=tmp_path / "report2", fused="yes")
    reports = [sorted(map(tuple, read_csv(spark, str(tmp_path / r), REPORT).collect())) for r in ("report", "report2")]
    assert reports[0] == reports[1]

    for _ in range(2):
        run("silver-increment", source="jobs_ns.bronze", root=tmp_path / "store")
        run("features-buckets", source="jobs_ns.silver", path=tmp_path / "buckets", buckets=4)
    said = capsys.readouterr().out
    assert "store: 1 days replaced" in said and "store: 0 days replaced" in said and "4 buckets replaced" in said
    assert silver_store.rows(spark, str(tmp_path / "store")).count() == 950
    run("insights", relations="jobs_ns.relations", features_path=tmp_path / "buckets", path=tmp_path / "report3")
    assert read_csv(spark, str(tmp_path / "report3"), REPORT).count() == 819

    run("report-queries", report_path=tmp_path / "report", path=tmp_path / "results", table="jobs_ns.report")
    assert spark.read.table("jobs_ns.report").count() == 819
    high_risk = spark.read.option("header", True).csv(str(tmp_path / "results" / "high_risk"))
    assert high_risk.count() == 50

    run("dashboard", relations="jobs_ns.relations", path=tmp_path / "dash", provider="parquet")
    totals = spark.read.parquet(str(tmp_path / "dash" / "totals")).first()
    assert tuple(totals) == (950, 128)

    spark.read.table("jobs_ns.relations").repartition(8).write.parquet(str(tmp_path / "many"))
    run("compact-small", path=tmp_path / "many", target_mb=1)
    assert spark.read.parquet(str(tmp_path / "many")).count() == 950
    assert len(list((tmp_path / "many").glob("*.parquet"))) == 1
    run("compact", source_path=tmp_path / "many", new_path=tmp_path / "few", partition_columns="country")
    assert spark.read.parquet(str(tmp_path / "few")).count() == 950

    run(
        "graph-export", relations="jobs_ns.relations", start="2024-01-01 01:00:00", end="2024-01-01 03:00:00",
        name="night", path=tmp_path / "graphs",
    )
    nodes = spark.read.option("header", True).csv(str(tmp_path / "graphs" / "night" / "nodes"))
    assert nodes.filter("kind = 'payment'").count() == 170

    run("train", report_path=tmp_path / "report", dataset_path=tmp_path / "text", model_path=tmp_path / "model")
    assert "accuracy" in capsys.readouterr().out
    assert spark.read.option("header", True).csv(str(tmp_path / "text")).columns == ["text", "label"]


def test_jobs_that_need_a_server_build_their_statements(spark, monkeypatch, capsys):
    """No broker, database or Iceberg catalog may run here: what they would get is checked."""
    replace_table(fixtures.payments(spark, SF), "served_bronze")
    sent = []
    monkeypatch.setattr(jobs.tables, "publish", lambda df, kind, **o: sent.append((df.count(), kind, o)))
    jobs.publish(spark, "served_bronze", "h:1", "t")
    assert sent == [(1000, "kafka", {"kafka.bootstrap.servers": "h:1", "topic": "t"})]
    staged = []
    monkeypatch.setattr(
        jobs.upsert, "write_jdbc_staging", lambda df, *to: staged.append((df.count(), *to))
    )
    jobs.features_jdbc(spark, "served_bronze", "jdbc:x", "fraud_features", "staging")
    assert staged == [(950, "jdbc:x", "staging", 16)]  # repeated ids are one row each
    assert "ON DUPLICATE KEY UPDATE" in capsys.readouterr().out
    with pytest.raises(Exception, match="(?i)rewrite_data_files|catalog|procedure"):
        jobs.compact_table(spark, "lake", "pay.silver")


def test_partition_count_is_a_parameter(spark):
    replace_table(fixtures.payments(spark, SF).limit(5), "five_bronze")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    jobs.main(["--partitions", "3", "silver-table", "--source", "five_bronze", "--target", "five"], spark)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_empty_source_stops_a_job_and_parameters_are_checked(spark, tmp_path):
    replace_table(fixtures.payments(spark, SF).limit(0), "empty_bronze")
    with pytest.raises(EmptySource):
        jobs.silver_table(spark, "empty_bronze", "never_written")
    assert not spark.catalog.tableExists("never_written")
    with pytest.raises(SystemExit):
        jobs.main(["silver-table", "--source", "x"], spark)
