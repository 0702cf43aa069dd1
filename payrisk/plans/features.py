"""Silver to the feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payrisk.functions.rules import declined
from payrisk.functions.values import TIME_FORMAT
from payrisk.schemas import FEATURE_TABLE

UNKNOWN = "unknown"
#: Copies of a row that are laid out at a time.
COPY_BLOCK = 10_000


def feature_rows(silver: DataFrame, now: Column | None = None) -> DataFrame:
    """The 9-column feature rows. ``now`` replaces the clock, e.g. for repeatable runs.

    ``risk_score`` is the card's declined ratio here; missing values get defaults. A missing
    payment id gets an id made from the row's whole content and, as rows can be identical, a number
    per copy: the same ids on every run, and no row is lost. ``silver`` is read once more for such
    rows, so give a stored table.
    """
    if "payment_id" not in silver.columns:
        return _feature_rows(_with_ids(silver.withColumn("payment_id", F.lit(None).cast("string"))), now)
    known = silver.filter(F.col("payment_id").isNotNull())
    unknown = _with_ids(silver.filter(F.col("payment_id").isNull()))
    return _feature_rows(known, now).unionByName(_feature_rows(unknown, now))


def _with_ids(rows: DataFrame) -> DataFrame:
    """Rows without id, each with one. Identical rows are counted before any shuffle and laid out
    again afterwards, so that no task gets all copies to number them."""
    names = [c for c in rows.columns if c != "payment_id"]
    content = F.to_json(F.struct(*sorted(names)), {"timestampFormat": TIME_FORMAT})
    block = F.lit(COPY_BLOCK)
    blocks = (
        rows.groupBy(*names)
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("first", F.explode(F.sequence(F.lit(0), F.col("copies") - 1, block)))
    )
    last = F.least(F.col("first") + block, F.col("copies")) - 1
    numbered = blocks.withColumn("copy", F.explode(F.sequence("first", last)))
    made_up = F.concat(F.lit("gen-"), F.sha2(content, 256), F.lit("-"), F.col("copy").cast("string"))
    return numbered.select(*names, made_up.alias("payment_id")).select(*rows.columns)


def _feature_rows(silver: DataFrame, now: Column | None) -> DataFrame:
    """Feature rows of payments that all have an id."""
    clock = F.current_timestamp() if now is None else now
    have = set(silver.columns)

    def field(name: str, kind: str, default: Column) -> Column:
        return F.coalesce(F.col(name).cast(kind), default) if name in have else default

    values = {
        "transaction_id": field("payment_id", "string", F.lit(None).cast("string")),
        "user_id": field("customer_id", "string", F.lit(UNKNOWN)),
        "amount": field("amount", "double", F.lit(0.0)),
        "is_fraud": declined(),
        "risk_score": field("declined_ratio_1h", "double", F.lit(0.0)),
        "event_time": F.date_trunc("second", field("event_time", "timestamp", clock)),
        "country": field("country", "string", F.lit(UNKNOWN)),
        "device_type": field("device_id", "string", F.lit(UNKNOWN)),
        "ingestion_time": F.date_trunc("second", field("ingestion_time", "timestamp", clock)),
    }
    return silver.select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in FEATURE_TABLE.fields]
    )
