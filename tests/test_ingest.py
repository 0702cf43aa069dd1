from __future__ import annotations

import json

from pyspark.sql import functions as F

from payrisk.plans import silver
from payrisk.schemas import CORRUPT, EVENT_COLUMNS
from payrisk.sinks.tables import as_messages, publish
from payrisk.streaming.ingest import kafka_options, message_stream, parse_events, start_bronze

GOOD = {
    "event_time": "2024-01-01T00:00:00.5", "payment_id": "P1", "customer_id": "C", "card_id": "K",
    "merchant_id": "M", "device_id": "D", "ip": "1.1.1.1", "country": "ES", "amount": 5.25,
    "currency": "EUR", "status": "approved", "mcc": 5411,
}


def _messages(spark, *texts):
    return spark.createDataFrame([(bytearray(t, "utf-8"),) for t in texts], "value binary")


def test_parsing_keeps_what_it_can(spark):
    bad_amount = json.dumps({**GOOD, "payment_id": "P2", "amount": "xx"})
    rows = parse_events(_messages(spark, json.dumps(GOOD), "{bad", bad_amount)).collect()
    assert rows[0]["mcc"] == "5411" and rows[0]["amount"] == 5.25 and rows[0][CORRUPT] is None
    assert rows[1][CORRUPT] == "{bad" and all(rows[1][c] is None for c in EVENT_COLUMNS)
    assert rows[2]["amount"] is None and rows[2]["payment_id"] == "P2"


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    inbox, table, checkpoint = (str(tmp_path / n) for n in ("inbox", "bronze", "checkpoint"))
    texts = [json.dumps({**GOOD, "payment_id": f"P{i}"}) for i in range(20)] + ["{bad"]

    def run(batch):
        spark.createDataFrame([(t,) for t in batch], "value string").write.mode("append").text(inbox)
        stream = message_stream(spark, "text", path=inbox)
        start_bronze(stream, checkpoint, path=table, until_caught_up=True).awaitTermination()
        return spark.read.parquet(table)

    assert run(texts[:10]).count() == 10
    stored = run(texts[10:])
    assert stored.columns == [*EVENT_COLUMNS, "ingestion_timestamp", CORRUPT]
    assert stored.filter("ingestion_timestamp IS NULL").count() == 0
    batch = parse_events(_messages(spark, *texts)).select(*EVENT_COLUMNS)
    assert stored.select(*EVENT_COLUMNS).exceptAll(batch).count() == 0
    assert stored.count() == 21
    assert silver.silver(stored).count() == 20


def test_stream_into_a_table(spark, tmp_path):
    inbox = str(tmp_path / "inbox")
    spark.createDataFrame([(json.dumps(GOOD),)], "value string").write.text(inbox)
    spark.sql("DROP TABLE IF EXISTS bronze_events")
    stream = message_stream(spark, "text", path=inbox)
    query = start_bronze(stream, str(tmp_path / "c"), table="bronze_events", until_caught_up=True)
    query.awaitTermination()
    assert spark.read.table("bronze_events").count() == 1


def test_broker_options_start_at_the_beginning():
    assert kafka_options("h:1", "t") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "1000000",
    }


def test_published_messages_parse_back(spark, event, tmp_path):
    rows = event({"amount": 1.5}, {"ip": None})
    messages = as_messages(rows)
    assert messages.columns == ["key", "value"]
    back = parse_events(messages).select(*EVENT_COLUMNS)
    assert back.exceptAll(rows).count() == 0 and back.count() == 2
    publish(rows, "json", path=str(tmp_path / "topic"))
    assert spark.read.json(str(tmp_path / "topic")).select(F.col("key")).count() == 2
