"""The pipeline steps as jobs over named tables and paths.

Run one with ``spark-submit payrisk/jobs.py <job> …`` or ``python -m payrisk.jobs <job> …``.
``--help`` lists jobs and parameters. Every table name, path and time range is a parameter.
"""

from __future__ import annotations

import argparse
import inspect
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from payrisk.functions.rules import ALERT_SCORE  # noqa: E402
from payrisk.plans import gold, graph, reports, silver_store, textset  # noqa: E402
from payrisk.plans.features import feature_rows  # noqa: E402
from payrisk.operators.fusion import fuse, suspicious  # noqa: E402
from payrisk.plans.insights import as_report, insights_report, store_sides  # noqa: E402
from payrisk.plans.silver import silver  # noqa: E402
from payrisk.schemas import GOLD_COLUMNS, REPORT  # noqa: E402
from payrisk.session import build_session, release_stages, stage  # noqa: E402
from payrisk.sinks import compaction, exports, partitions, tables, upsert  # noqa: E402
from payrisk.sources.jdbc import read_ranges  # noqa: E402
from payrisk.sources.tables import (  # noqa: E402
    external_csv_table,
    read_csv,
    read_table,
    require_rows,
)
from payrisk.streaming.ingest import kafka_options, message_stream, start_bronze  # noqa: E402


def _yes(value: str) -> bool:
    return value.lower() in ("yes", "true", "1")


def _source(spark: SparkSession, name: str) -> DataFrame:
    return require_rows(read_table(spark, name), name)


def _payments(spark: SparkSession, name: str) -> DataFrame:
    """Rows for other systems, without the column that only partitions the stored table."""
    return _source(spark, name).drop(gold.EVENT_DAY)


def bronze(
    spark: SparkSession,
    servers: str,
    topic: str,
    table: str,
    checkpoint: str,
    provider: str = "iceberg",
    max_offsets: str = "1000000",
) -> None:
    """Follow a topic into a bronze table until the job is stopped, that many messages a batch."""
    if "." in table:
        tables.create_namespace(spark, table.rsplit(".", 1)[0])
    stream = message_stream(spark, "kafka", **kafka_options(servers, topic, max_offsets))
    start_bronze(stream, checkpoint, table=table, provider=provider).awaitTermination()


def silver_table(spark: SparkSession, source: str, target: str, provider: str = "parquet") -> None:
    """Bronze table to silver table, replacing it."""
    rows, seen = tables.counted(silver(_source(spark, source)), "silver")
    tables.replace_table(rows, target, provider)
    print(f"{target}: {seen.get['rows']} rows")


def gold_tables(
    spark: SparkSession,
    source: str,
    relations: str,
    alerts: str,
    provider: str = "parquet",
    keep_reasons: str = "no",
    by_day: str = "yes",
) -> None:
    """Silver table to relations and alerts, with the list of reasons if keep_reasons is yes.
    Alerts are filtered out of the stored relations. With by_day, relations are partitioned by the
    day of the event time, which time ranges prune by."""
    rows = gold.relations(_source(spark, source), _yes(keep_reasons))
    rows, seen = tables.counted(rows, "relations")
    days = [gold.EVENT_DAY] if _yes(by_day) else []
    scored = tables.replace_table(gold.with_day(rows) if days else rows, relations, provider, days)
    print(f"{relations}: {seen.get['rows']} rows")
    found = scored.filter(F.col("risk_score") >= ALERT_SCORE).drop(gold.EVENT_DAY)
    tables.replace_table(found, alerts, provider)


def publish(spark: SparkSession, source: str, servers: str, topic: str) -> None:
    """A table as JSON messages to a topic, keyed by payment."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    tables.publish(_payments(spark, source), "kafka", **options)


def export(
    spark: SparkSession, source: str, path: str, granularity: str = "day", provider: str = "json"
) -> None:
    """A table to time-partitioned files."""
    exports.export_by_time(_payments(spark, source), path, granularity, provider)


def features(spark: SparkSession, source: str, new_path: str, target_path: str = "") -> None:
    """Silver table upserted into a feature table on Parquet; the first load has no target yet."""
    rows = upsert.as_one_batch(feature_rows(_source(spark, source)))
    if target_path:
        upsert.write_upsert(spark, target_path, rows, new_path)
    else:
        rows.write.parquet(new_path)


def features_buckets(spark: SparkSession, source: str, path: str, buckets: str = "64") -> None:
    """Silver table upserted in place into a feature table in hash buckets, which the first run
    makes; only the buckets of the batch's keys are read and rewritten."""
    rows = upsert.as_one_batch(feature_rows(_source(spark, source)))
    if partitions.exists(spark, path):
        touched = upsert.upsert_buckets(spark, path, rows)
        print(f"{path}: {len(touched)} buckets replaced")
    else:
        upsert.create_buckets(rows, path, buckets=int(buckets))


def silver_increment(spark: SparkSession, source: str, root: str) -> None:
    """New bronze rows into a silver store; only the days that they reach are recomputed."""
    change = silver_store.update(spark, root, _source(spark, source))
    print(f"{root}: {len(change.days)} days replaced")


def features_merge(spark: SparkSession, source: str, target: str) -> None:
    """The same into a catalog table that supports MERGE."""
    rows = upsert.as_one_batch(feature_rows(_source(spark, source)))
    rows.createOrReplaceTempView("payrisk_feature_batch")
    spark.sql(upsert.merge_statement(target, "payrisk_feature_batch", rows.columns))


def features_jdbc(
    spark: SparkSession, source: str, url: str, target: str, staging: str, connections: str = "16"
) -> None:
    """The same for a database table: executors fill a staging table, and the statement that the
    database then runs is printed for its own client."""
    rows = upsert.as_one_batch(feature_rows(_source(spark, source)))
    upsert.write_jdbc_staging(rows, url, staging, int(connections))
    print(upsert.mysql_upsert_statement(target, staging, rows.columns))


def fusion_tables(
    spark: SparkSession,
    relations: str,
    features_path: str,
    cleaned: str,
    features: str,
    buckets: str = "256",
    unique: str = "yes",
) -> None:
    """Relations and the feature table, cleaned, as two tables in the same buckets of the payment
    id: reports over them join without a shuffle. As many buckets as either side has 512 MB."""
    known = require_rows(upsert.read_stored(spark, features_path), features_path)
    rows = _source(spark, relations)
    rows = rows.select(*GOLD_COLUMNS, *(c for c in ("reasons",) if c in rows.columns))
    store_sides(rows, known, (cleaned, features), int(buckets), _yes(unique))


def insights(
    spark: SparkSession,
    relations: str,
    features_path: str,
    path: str,
    features_url: str = "",
    unique: str = "yes",
    features_column: str = "transaction_id",
    connections: str = "16",
    fused: str = "no",
) -> None:
    """Relations and feature table to the insights report. With fused, both are tables that
    fusion-tables has made. With features_url, features_path names a
    database table, which is read over ranges of features_column, at most that many connections at
    a time. Give unique no if ids repeat in either."""
    if _yes(fused):
        sides = _source(spark, relations), _source(spark, features_path)
        report, seen = tables.counted(as_report(suspicious(fuse(*sides))), "insights")
        tables.write_csv(report, path)
        print(f"{path}: {seen.get['rows']} rows")
        return
    if features_url:
        known = read_ranges(spark, features_url, features_path, features_column, int(connections))
    else:
        known = upsert.read_stored(spark, features_path)
    known = require_rows(known, features_path)
    rows = _source(spark, relations)
    rows = rows.select(*GOLD_COLUMNS, *(c for c in ("reasons",) if c in rows.columns))
    report, seen = tables.counted(insights_report(rows, known, _yes(unique)), "insights")
    tables.write_csv(report, path)
    print(f"{path}: {seen.get['rows']} rows")


def report_queries(
    spark: SparkSession, report_path: str, path: str, table: str = "insights_report", provider: str = "csv"
) -> None:
    """The report queries over the insights report, one folder each."""
    report = external_csv_table(spark, table, report_path, REPORT)
    results = {
        "high_risk": reports.high_risk(report),
        "customer_activity": reports.activity(report, "customer_id"),
        "card_activity": reports.activity(report, "card_id"),
        "geo_patterns": reports.geo_patterns(report),
    }
    tables.write_results(results, path, provider)


def dashboard(spark: SparkSession, relations: str, path: str, provider: str = "csv") -> None:
    """The dashboard queries over relations, one folder each."""
    rows = _source(spark, relations)
    results = {
        "totals": reports.totals(rows),
        "timeline": reports.timeline(rows),
        "top_merchants": reports.top_risk(rows, "merchant_id"),
        "top_cards": reports.top_risk(rows, "card_id"),
    }
    tables.write_results(results, path, provider)


def compact(
    spark: SparkSession, source_path: str, new_path: str, partition_columns: str = ""
) -> None:
    """Rewrite a Parquet folder with fewer files, below comma-separated partition columns."""
    columns = [c for c in partition_columns.split(",") if c]
    compaction.compact(spark, source_path, new_path, partition_columns=columns)


def compact_small(spark: SparkSession, path: str, target_mb: str = "256") -> None:
    """Merge the small files of a Parquet table in place; large files are left alone."""
    placed = compaction.compact_small_files(spark, path, int(target_mb) << 20)
    print(f"{path}: {placed} new files")


def compact_table(spark: SparkSession, catalog: str, table: str) -> None:
    """Compact a catalog table in place, where the catalog can."""
    spark.sql(compaction.rewrite_statement(catalog, table))


def graph_export(
    spark: SparkSession, relations: str, start: str, end: str, name: str, path: str
) -> None:
    """Nodes, edges and graph queries of a time range, below ``path/name``."""
    rows = gold.time_slice(_source(spark, relations), start, end)
    results = {
        "nodes": graph.nodes(rows),
        "edges": graph.edges(rows),
        "shared_devices": graph.shared_devices(rows),
        "multi_country_cards": graph.multi_country_cards(rows),
        "suspicious_merchants": graph.suspicious_merchants(rows),
        "anomaly_components": graph.anomaly_components(rows),
    }
    tables.write_results(results, f"{path}/{name}")


def train(spark: SparkSession, report_path: str, dataset_path: str, model_path: str) -> None:
    """Insights report to text set and baseline model; prints the validation accuracy."""
    rows = stage(textset.text_set(read_csv(spark, report_path, REPORT), keep_id=True), "text-set")
    tables.write_csv(rows.drop("payment_id"), dataset_path)
    training, validation = textset.split(rows)
    model = textset.train(training)
    textset.save(model, model_path)
    print(f"accuracy {textset.accuracy(model, validation):.4f}")


JOBS = {
    f.__name__.replace("_", "-"): f
    for f in (
        bronze, silver_table, silver_increment, gold_tables, publish, export, features,
        features_buckets, features_merge, features_jdbc, fusion_tables, insights, report_queries,
        dashboard, compact, compact_small, compact_table, graph_export, train,
    )
}


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="payrisk", description=__doc__)
    parser.add_argument(
        "--partitions",
        help="shuffle partitions before AQE merges them: about input bytes / 128 MB",
    )
    commands = parser.add_subparsers(dest="job", required=True)
    for name, job in JOBS.items():
        command = commands.add_parser(name, help=(job.__doc__ or "").strip())
        for parameter in list(inspect.signature(job).parameters.values())[1:]:
            required = parameter.default is inspect.Parameter.empty
            command.add_argument(
                f"--{parameter.name.replace('_', '-')}",
                required=required,
                default=None if required else parameter.default,
            )
    chosen = vars(parser.parse_args(arguments))
    name, partitions = chosen.pop("job"), chosen.pop("partitions")
    session = spark or build_session(f"payrisk-{name}")
    if partitions:
        session.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        JOBS[name](session, **chosen)
    finally:
        release_stages(session)


if __name__ == "__main__":
    main()
