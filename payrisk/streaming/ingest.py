"""Event stream to bronze. The transformation is the same for streams and batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from payrisk.schemas import CORRUPT, EVENT

MESSAGES = T.StructType([T.StructField("value", T.StringType())])


def kafka_options(servers: str, topic: str, max_offsets: str = "1000000") -> dict[str, str]:
    """Read one topic from its start; later runs go on from the checkpoint. A batch takes at most
    ``max_offsets`` messages, so the first one is not the whole topic."""
    return {
        "maxOffsetsPerTrigger": max_offsets,
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }


def message_stream(spark: SparkSession, provider: str = "kafka", **options: str) -> DataFrame:
    """A stream with a ``value`` column, from a broker or from a folder of text files."""
    reader = spark.readStream.format(provider).options(**options)
    if provider == "text":
        reader = reader.schema(MESSAGES)
    return reader.load()


def parse_events(messages: DataFrame) -> DataFrame:
    """JSON messages as the 12 event columns. Text that does not fit stays in ``_corrupt_record``."""
    schema = T.StructType([*EVENT.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(
        F.col("value").cast("string"), schema, {"columnNameOfCorruptRecord": CORRUPT}
    )
    return messages.select(parsed.alias("event")).select("event.*")


def bronze_rows(messages: DataFrame) -> DataFrame:
    """Event columns, ingestion time, and the raw text of unreadable messages."""
    return parse_events(messages).select(
        *EVENT.names, F.current_timestamp().alias("ingestion_timestamp"), CORRUPT
    )


def start_bronze(
    messages: DataFrame,
    checkpoint: str,
    table: str | None = None,
    path: str | None = None,
    provider: str = "parquet",
    until_caught_up: bool = False,
) -> StreamingQuery:
    """Append the stream to a table or folder. Runs until stopped, or only over what is there."""
    if (table is None) == (path is None):
        raise ValueError("give either a table or a path")
    writer = (
        bronze_rows(messages)
        .writeStream.format(provider)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if until_caught_up:
        writer = writer.trigger(availableNow=True)
    return writer.toTable(table) if table else writer.start(path)
