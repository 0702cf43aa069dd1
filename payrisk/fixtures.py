"""Payment feeds projected from the ``events`` table (see FIXTURES.md)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payrisk.schemas import EVENT_COLUMNS
from payrisk.session import configure

DAY_START_US = 1_704_067_200_000_000
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = configure(spark).read.parquet(f"{sf_dir}/events.parquet")
    return events.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("us"),
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        F.expr("user_id div 3").alias("card"),
    )


def _event_us(compress: bool) -> str:
    if not compress:
        return "us"
    return f"{DAY_START_US} + ((us - {DAY_START_US}) div 60)"


def _payment_columns(compress: bool) -> dict[str, str]:
    return {
        "event_time": f"date_format(timestamp_micros({_event_us(compress)}), \"{ISO_MICROS}\")",
        "payment_id": "concat('PAY-', if(event_id % 20 = 19, event_id - 1, event_id))",
        "customer_id": "concat('CUST-', user_id)",
        "card_id": "concat('CARD-', card)",
        "merchant_id": "concat('MERCH-', k % 20)",
        "device_id": "if(k % 10 = 0, concat('DEV-S', card % 4), concat('DEV-', card))",
        "ip": "concat('192.168.1.', user_id % 255 + 1)",
        "country": "CASE WHEN k < 94 THEN 'ES' WHEN k < 96 THEN 'US' WHEN k < 98 THEN 'FR' ELSE 'DE' END",
        "amount": "value * 10",
        "currency": "'EUR'",
        "status": "if(event_type = 'error', 'declined', 'approved')",
        "mcc": "CASE k % 3 WHEN 0 THEN '5411' WHEN 1 THEN '5812' ELSE '5311' END",
    }


def payments(spark: SparkSession, sf_dir: str, compress: bool = True) -> DataFrame:
    """The payment feed in bronze shape; ``compress`` squeezes the 30 days into 12 hours."""
    columns = _payment_columns(compress)
    return _base(spark, sf_dir).select(*[F.expr(columns[c]).alias(c) for c in EVENT_COLUMNS])


def payment_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as the broker holds it: a binary JSON ``value`` with ``mcc`` as a number."""
    fields = [F.col(c).cast("int").alias(c) if c == "mcc" else F.col(c) for c in EVENT_COLUMNS]
    return payments(spark, sf_dir).select(
        F.to_json(F.struct(*fields)).cast("binary").alias("value")
    )


def payments_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with defects in ids, cards, amounts, countries and status, for the cleaning rules."""
    columns = _payment_columns(True)
    columns.update(
        payment_id="CASE WHEN event_id % 7 = 0 THEN concat('  PAY-', event_id, ' ') "
        "WHEN event_id % 20 = 19 THEN concat('PAY-', event_id - 1) ELSE concat('PAY-', event_id) END",
        card_id="CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 5 = 0 THEN concat(' card-', k) "
        "ELSE concat('CARD-', k) END",
        amount="CASE WHEN event_id % 50 = 1 THEN 'abc' WHEN event_id % 41 = 0 THEN '-5.0' "
        "WHEN event_id % 43 = 0 THEN NULL ELSE CAST(k + 0.5 AS STRING) END",
        country="CASE WHEN k < 40 THEN 'ES' WHEN k < 55 THEN 'es' WHEN k < 65 THEN ' España ' "
        "WHEN k < 70 THEN 'Spain' WHEN k < 75 THEN 'unknown' WHEN k < 80 THEN NULL ELSE 'FR' END",
        status="if(event_type = 'error', ' Declined ', 'APPROVED')",
    )
    return _base(spark, sf_dir).select(
        "event_id", *[F.expr(columns[c]).alias(c) for c in EVENT_COLUMNS]
    )


def write_json_arrays(rows: DataFrame, path: str) -> None:
    """Rows as other producers hand them over: files that hold one indented array each."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = "["
        for batch in batches:
            out = []
            for record in batch.column(0).to_pylist():
                out += [before, "  " + record]
                before = ","
            yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.string())})
        yield pa.RecordBatch.from_pydict({"value": ["[", "]"] if before == "[" else ["]"]})

    records = rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("r"))
    files = f"{path}/files"
    records.mapInArrow(lines, "value string").write.text(files)
    _named_json(rows.sparkSession, files)


def _named_json(spark: SparkSession, folder: str) -> None:
    """Spark's text files end in .txt."""
    location = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = location.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(location):
        name = status.getPath().getName()
        if name.endswith(".txt"):
            files.rename(status.getPath(), spark._jvm.org.apache.hadoop.fs.Path(location, name[:-4] + ".json"))
