"""Every operator as a named query over a folder of input tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payrisk import fixtures
from payrisk.functions.rules import scored
from payrisk.operators import component_store
from payrisk.operators.card_windows import CARD_FEATURES
from payrisk.operators.cleaning import clean_payments
from payrisk.operators.device_sharing import with_cards_per_device
from payrisk.operators.fusion import fuse, suspicious
from payrisk.plans import dashboard_store, gold, graph, reports, silver, silver_store, textset
from payrisk.plans.features import feature_rows
from payrisk.plans.insights import fused_payments, insights_report, store_sides
from payrisk.schemas import EVENT, EVENT_COLUMNS, REPORT
from payrisk.session import scratch_path, stage
from payrisk.sinks import compaction, exports, partitions, tables, upsert
from payrisk.sources.tables import external_csv_table, read_csv, read_json, read_mixed
from payrisk.streaming.ingest import message_stream, parse_events, start_bronze

Query = Callable[[SparkSession, str], DataFrame]

# The feature rows carry the load time; a fixed one makes runs comparable.
LOAD_TIME = "2024-01-02 00:00:00"


def comparable(df: DataFrame) -> DataFrame:
    """Types that any engine agrees on: times as epoch microseconds, integers as long."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            name = field.name.removesuffix("_time") + "_us"
            columns.append(F.unix_micros(column).alias(name))
        elif isinstance(field.dataType, T.IntegerType):
            columns.append(column.cast("long").alias(field.name))
        else:
            columns.append(column)
    return df.select(*columns)


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Sums and means of doubles depend on the order of addition in their last bits."""
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


# Stages of the pipeline over the payment feed.


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.payments(spark, sf_dir)


def _deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.deduplicated(_bronze(spark, sf_dir))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver(_bronze(spark, sf_dir))


def _relations(spark: SparkSession, sf_dir: str, keep_reasons: bool = False) -> DataFrame:
    return gold.relations(_silver(spark, sf_dir), keep_reasons)


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_payments(fixtures.payments_dirty(spark, sf_dir), ["event_id"])


def _load_time():
    return F.lit(LOAD_TIME).cast("timestamp")


def _second_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature rows of the cleaned second feed; it shares only part of its ids with silver."""
    return feature_rows(stage(_cleaned(spark, sf_dir), "cleaned"), _load_time())


def _stored_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(_relations(spark, sf_dir), "relations")


def _report_path(spark: SparkSession, sf_dir: str) -> str:
    """Where the insights report has been written."""
    relations = _relations(spark, sf_dir, keep_reasons=True)
    path = scratch_path(spark, "insights")
    tables.write_csv(insights_report(relations, _second_feed(spark, sf_dir)), path)
    return path


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored insights report, as the jobs hand it on."""
    return read_csv(spark, _report_path(spark, sf_dir), REPORT)


# Ingest.


def bronze_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = fixtures.payment_messages(spark, sf_dir)
    return comparable(parse_events(messages).select(*EVENT_COLUMNS))


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    inbox = scratch_path(spark, "inbox")
    fixtures.payment_messages(spark, sf_dir).select(F.col("value").cast("string")).write.text(inbox)
    table, checkpoint = scratch_path(spark, "bronze"), scratch_path(spark, "checkpoint")
    stream = message_stream(spark, "text", path=inbox)
    start_bronze(stream, checkpoint, path=table, until_caught_up=True).awaitTermination()
    return comparable(spark.read.parquet(table).select(*EVENT_COLUMNS))


def publish_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.as_messages(_bronze(spark, sf_dir))


def publish_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of rows with real timestamps."""
    return tables.as_messages(_relations(spark, sf_dir))


# Silver.


def silver_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_deduplicated(spark, sf_dir))


def _card_feature(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        features = silver.card_behaviour(_bronze(spark, sf_dir), [name])
        return comparable(features.select("payment_id", name))

    return query


def cards_per_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver.stored(_bronze(spark, sf_dir))
    counted = with_cards_per_device(rows, rows)
    return comparable(counted.select("payment_id", "distinct_cards_per_device"))


def silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_silver(spark, sf_dir))


# Gold.


def reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(_silver(spark, sf_dir), keep_reasons=True)
    return rows.select(
        "payment_id",
        F.concat_ws("|", "reasons").alias("reasons"),
        F.size("reasons").cast("long").alias("n_reasons"),
        "reasons_text",
    )


def risk_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_relations(spark, sf_dir).select("payment_id", "risk_score"))


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(gold.alerts(_silver(spark, sf_dir)))


def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_relations(spark, sf_dir))


def recompute_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of declined payments are taken as not computed yet."""
    rows = _relations(spark, sf_dir)
    known = F.when(F.col("status") != "declined", F.col("risk_score"))
    return comparable(
        rows.select(
            "payment_id",
            gold.score_or_zero(known).alias("score_or_zero"),
            gold.score_or_recomputed(known).alias("score_recomputed"),
        )
    )


def time_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of relations that are stored by day, as the jobs store them."""
    path = scratch_path(spark, "relations-by-day")
    partitions.create(gold.with_day(_relations(spark, sf_dir)), path, gold.EVENT_DAY)
    rows = gold.time_slice(spark.read.parquet(path), "2024-01-01 01:00:00", "2024-01-01 03:00:00")
    return comparable(rows.drop(gold.EVENT_DAY))


# Exports, feature table, compaction.


def _exported(df: DataFrame, granularity: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, f"export-{granularity}")
    exports.export_by_time(df, path, granularity)
    return comparable(exports.read_export(spark, path, df.schema, granularity))


def export_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per exported minute of the alerts."""
    rows = gold.alerts(_silver(spark, sf_dir))
    path = scratch_path(spark, "export-alerts")
    exports.export_by_time(rows, path, "minute")
    stored = exports.read_export(spark, path, rows.schema, "minute")
    return exports.partition_counts(stored, "minute")


def export_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exported(_relations(spark, sf_dir), "minute")


def export_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = fixtures.payments(spark, sf_dir, compress=False)
    return _exported(silver.silver(month), "day")


def features_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(feature_rows(stage(_silver(spark, sf_dir), "silver"), _load_time()))


def _silver_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_rows(stage(_silver(spark, sf_dir), "silver"), _load_time())


def _upserted(loaded: DataFrame, *batches: DataFrame) -> DataFrame:
    """A stored table, in buckets, after one batch and the next."""
    spark, path = loaded.sparkSession, scratch_path(loaded.sparkSession, "feature-table")
    upsert.create_buckets(loaded, path, buckets=16)
    for batch in batches:
        upsert.upsert_buckets(spark, path, batch)
    return comparable(upsert.read_buckets(spark, path))


def features_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second feed is the loaded table; the silver rows are the new batch."""
    return _upserted(_second_feed(spark, sf_dir), _silver_batch(spark, sf_dir))


def features_upsert_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch is the feed before deduplication: some payments come twice."""
    batch = feature_rows(stage(silver.typed(_bronze(spark, sf_dir)), "typed"), _load_time())
    return _upserted(_second_feed(spark, sf_dir), upsert.as_one_batch(batch))


def features_upsert_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, one after the other: the silver rows, then corrections of the ones from FR and
    payments of a new kind."""
    rows = stage(_silver_batch(spark, sf_dir), "features")
    foreign = rows.filter(F.col("country") == "FR")
    corrected = foreign.withColumns({"amount": F.col("amount") * 2, "country": F.lit("DE")})
    refunds = foreign.withColumn("transaction_id", F.concat(F.lit("REFUND-"), "transaction_id"))
    return _upserted(_second_feed(spark, sf_dir), rows, corrected.unionByName(refunds))


# Stores that increments go into.

#: The second increment: the last days, and what a merchant has sent late.
LATE = "event_time >= '2024-01-25' OR (merchant_id = 'MERCH-7' AND event_time >= '2024-01-10')"


def _two_increments(spark: SparkSession, sf_dir: str) -> tuple[str, list[silver_store.Change]]:
    """A silver store over the month's feed, taken in as two increments."""
    month = fixtures.payments(spark, sf_dir, compress=False)
    root = scratch_path(spark, "silver-store")
    late = F.coalesce(F.expr(LATE), F.lit(False))
    return root, [silver_store.update(spark, root, month.filter(part), 16) for part in (~late, late)]


def silver_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = _two_increments(spark, sf_dir)
    return comparable(silver_store.silver(spark, root).drop(silver_store.DAY))


def device_counts_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = _two_increments(spark, sf_dir)
    return silver_store.devices(spark, root)


def _dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored partials that have followed the silver store over both increments."""
    month = fixtures.payments(spark, sf_dir, compress=False)
    root, path = scratch_path(spark, "silver-store"), scratch_path(spark, "dashboard")
    late = F.coalesce(F.expr(LATE), F.lit(False))
    for part in (~late, late):
        change = silver_store.update(spark, root, month.filter(part), 16)
        dashboard_store.follow(spark, path, root, change)
    return dashboard_store.read(spark, path)


def timeline_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dashboard_store.timeline(_dashboard(spark, sf_dir))
    return rows.withColumn("bucket_start", F.unix_micros("bucket_start"))


def _top_increments(kind: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = dashboard_store.top_risk(_dashboard(spark, sf_dir), kind)
        return comparable(_rounded(rows, mean_score=9))

    return query


def _activity_increments(kind: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = dashboard_store.activity(_dashboard(spark, sf_dir), kind)
        return comparable(_rounded(rows, monto_promedio=9))

    return query


def components_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters over the alerts of the morning, then those of the rest of the day."""
    rows, path = _stored_relations(spark, sf_dir), scratch_path(spark, "clusters")
    morning = F.hour("event_time") < 6
    for part in (morning, ~morning):
        component_store.add_links(spark, path, graph.alert_links(rows.filter(part)), 16)
    return component_store.read(spark, path)


def compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_files = scratch_path(spark, "small-files")
    _relations(spark, sf_dir).repartition(40).write.parquet(small_files)
    return comparable(compaction.compact(spark, small_files, scratch_path(spark, "compacted")))


def compacted_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small files below partition folders become files of about the target size."""
    path = scratch_path(spark, "small-files-by-country")
    _relations(spark, sf_dir).repartition(8).write.partitionBy("country").parquet(path)
    compaction.compact_small_files(spark, path, 8 << 20)
    return comparable(spark.read.parquet(path))


# Mixed sources, cleaning, fusion, report.


def mixed_source_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approved payments arrive as JSON, declined ones as CSV without the ip."""
    rows = _bronze(spark, sf_dir)
    prefix = scratch_path(spark, "mixed")
    rows.filter(F.col("status") == "approved").write.json(f"{prefix}/part-a")
    tables.write_csv(rows.filter(F.col("status") != "approved").drop("ip"), f"{prefix}/part-b")
    without_ip = T.StructType([f for f in EVENT.fields if f.name != "ip"])
    return comparable(read_mixed(spark, prefix, EVENT, without_ip))


def json_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments in array files, with text that has braces, quotes and escapes in it."""
    rows = _bronze(spark, sf_dir).withColumns(
        {
            "ip": F.expr(
                r"""CASE mcc WHEN '5411' THEN '{"a": [}' WHEN '5812' THEN '\\\\"}{' ELSE ip END"""
            ),
            "currency": F.expr("if(mcc = '5311', NULL, currency)"),
        }
    )
    path = scratch_path(spark, "arrays")
    fixtures.write_json_arrays(rows, path)
    return comparable(read_json(spark, path, EVENT, whole_files=True))


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_cleaned(spark, sf_dir).drop("event_id"))


def fused_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over two tables in the same buckets, as the jobs store them."""
    names = tuple(f"payrisk_{side}_{uuid.uuid4().hex}" for side in ("gold", "features"))
    sides = store_sides(_relations(spark, sf_dir), _second_feed(spark, sf_dir), names, 8)
    fused = stage(fuse(*sides), "fused")
    for name in names:
        tables.drop_table(spark, name)
    return comparable(fused)


def suspicious_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    fused = fused_payments(_relations(spark, sf_dir), _second_feed(spark, sf_dir))
    return comparable(suspicious(fused))


def insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_report(spark, sf_dir))


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The defective feed with text that CSV files are bad at, written and read back."""
    rows = fixtures.payments_dirty(spark, sf_dir).withColumns(
        {
            "status": F.expr("if(event_id % 3 = 0, concat(' \"', status, '\" '), status)"),
            "currency": F.expr(
                "CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'a,b' ELSE ' ' END"
            ),
            "mcc": F.expr(r"concat_ws('\n', mcc, if(event_id % 2 = 0, 'x\\ny', 'z\r\\'))"),
        }
    )
    path = scratch_path(spark, "csv")
    tables.write_csv(rows, path)
    stored = read_csv(spark, path, rows.schema)
    breaks = F.length("mcc") - F.length(F.replace("mcc", F.lit("\n"), F.lit("")))
    return stored.select(
        "event_id",
        "payment_id",
        "card_id",
        "amount",
        "country",
        "currency",
        "status",
        F.md5(F.col("mcc").cast("binary")).alias("mcc_md5"),
        breaks.cast("long").alias("line_breaks"),
    )


# Reports and dashboards.


def high_risk_top50(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _report_path(spark, sf_dir)
    name = f"payrisk_report_{uuid.uuid4().hex}"
    # The rows are kept, the catalog entry is not: the files below it stay until the session ends.
    found = stage(reports.high_risk(external_csv_table(spark, name, path, REPORT)), "high-risk")
    tables.drop_table(spark, name)
    return comparable(found.orderBy(F.desc("amount"), F.desc("puntuacion_riesgo"), "payment_id"))


def _activity(by: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = reports.activity(_report(spark, sf_dir), by)
        return comparable(_rounded(rows, monto_promedio=9))

    return query


def geo_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reports.geo_patterns(_report(spark, sf_dir))
    return _rounded(rows, capital_en_riesgo=2, riesgo_medio=9)


def dashboard_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.totals(_relations(spark, sf_dir))


def alerts_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reports.timeline(_relations(spark, sf_dir))
    return rows.withColumn("bucket_start", F.unix_micros("bucket_start"))


def _top_risk(by: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = reports.top_risk(_relations(spark, sf_dir), by)
        return comparable(_rounded(rows, mean_score=9))

    return query


# Graph.


def anomaly_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.anomaly_components(_relations(spark, sf_dir))


# Text set and classifier.


def nlp_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = textset.text_set(_report(spark, sf_dir), keep_id=True)
    path = scratch_path(spark, "text-set")
    tables.write_csv(rows, path)
    return comparable(read_csv(spark, path, rows.schema))


def train_val_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = textset.text_set(_report(spark, sf_dir), keep_id=True)
    return textset.with_part(rows).select("payment_id", "part")


def classifier_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(textset.text_set(_report(spark, sf_dir), keep_id=True), "text-set")
    train, validation = textset.split(rows)
    predicted = textset.train(train).transform(validation)
    return textset.evaluation(predicted)


QUERIES: dict[str, Query] = {
    "bronze_parse": bronze_parse,
    "stream_bronze": stream_bronze,
    "publish_json": publish_json,
    "publish_typed": publish_typed,
    "silver_typed": silver_typed,
    **{name: _card_feature(name) for name in CARD_FEATURES},
    "cards_per_device": cards_per_device,
    "silver": silver_table,
    "reasons": reasons,
    "risk_score": risk_score,
    "alerts": alerts,
    "relations": relations,
    "recompute_risk": recompute_risk,
    "time_slice": time_slice,
    "export_counts": export_counts,
    "export_minute": export_minute,
    "export_day": export_day,
    "features_map": features_map,
    "features_upsert": features_upsert,
    "features_upsert_repeats": features_upsert_repeats,
    "features_upsert_batches": features_upsert_batches,
    "silver_increments": silver_increments,
    "device_counts_increments": device_counts_increments,
    "timeline_increments": timeline_increments,
    "top_merchants_increments": _top_increments("merchant"),
    "card_activity_increments": _activity_increments("card"),
    "components_increments": components_increments,
    "compaction": compacted,
    "compaction_in_place": compacted_in_place,
    "mixed_source_union": mixed_source_union,
    "json_arrays": json_arrays,
    "clean": clean,
    "fused_join": fused_join,
    "suspicious": suspicious_payments,
    "insights_report": insights,
    "csv_round_trip": csv_round_trip,
    "high_risk_top50": high_risk_top50,
    "customer_activity": _activity("customer_id"),
    "card_activity": _activity("card_id"),
    "geo_patterns": geo_patterns,
    "dashboard_totals": dashboard_totals,
    "alerts_timeline": alerts_timeline,
    "top_risk_merchants": _top_risk("merchant_id"),
    "top_risk_cards": _top_risk("card_id"),
    "graph_nodes": lambda spark, sf_dir: graph.nodes(_stored_relations(spark, sf_dir)),
    "graph_edges": lambda spark, sf_dir: graph.edges(_stored_relations(spark, sf_dir)),
    "shared_devices": lambda spark, sf_dir: graph.shared_devices(_relations(spark, sf_dir)),
    "multi_country_cards": lambda spark, sf_dir: graph.multi_country_cards(
        _relations(spark, sf_dir)
    ),
    "suspicious_merchants": lambda spark, sf_dir: graph.suspicious_merchants(
        _relations(spark, sf_dir)
    ),
    "anomaly_components": anomaly_components,
    "nlp_dataset": nlp_dataset,
    "train_val_split": train_val_split,
    "classifier_accuracy": classifier_accuracy,
}
