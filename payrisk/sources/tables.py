"""Batch sources. Every reader takes a declared schema: inferring one costs an extra pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from payrisk.sources.csv import CSV_OPTIONS, unescaped_lines
from payrisk.sources.json_arrays import read_json_arrays


class EmptySource(ValueError):
    """A job input has no rows."""


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table. Jobs select their columns, so the scan reads no others."""
    return spark.read.table(name)


def read_json(
    spark: SparkSession, prefix: str, schema: T.StructType, whole_files: bool = False
) -> DataFrame:
    """All ``.json`` objects below ``prefix``, at any depth.

    JSON Lines, as the exports here write them, is the default. Use ``whole_files`` for objects that
    hold one array or one record each, as other producers write them; they are split as well, but
    read twice.
    """
    if whole_files:
        return read_json_arrays(spark, prefix, schema)
    return (
        spark.read.schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .json(prefix)
    )


def read_csv(
    spark: SparkSession, prefix: str, schema: T.StructType, escaped: bool = True
) -> DataFrame:
    """All ``.csv`` objects below ``prefix``; the header has to agree with ``schema``.

    Files of other producers are read with ``escaped`` false: their backslashes are only that."""
    rows = (
        spark.read.schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .option("enforceSchema", False)
        .options(**CSV_OPTIONS)
        .csv(prefix)
    )
    return unescaped_lines(rows) if escaped else rows


def read_mixed(
    spark: SparkSession,
    prefix: str,
    json_schema: T.StructType,
    csv_schema: T.StructType,
    whole_files: bool = False,
) -> DataFrame:
    """JSON and CSV records below one prefix as one bag; columns one side lacks are null."""
    return read_json(spark, prefix, json_schema, whole_files).unionByName(
        read_csv(spark, prefix, csv_schema), allowMissingColumns=True
    )


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 1,
    **options: str,
) -> DataFrame:
    """A database table, read in parallel over ranges of ``partition_column`` when it is given."""
    reader = spark.read.format("jdbc").options(
        **jdbc_options(url, table, partition_column, bounds, partitions, **options)
    )
    return reader.load()


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 1,
    **options: str,
) -> dict[str, str]:
    """Reader options; a partitioned read needs the column, both bounds and the count together."""
    result = {"url": url, "dbtable": table, "fetchsize": "10000", **options}
    if (partition_column is None) != (bounds is None):
        raise ValueError("give partition_column and bounds together")
    if partition_column is not None and bounds is not None:
        result.update(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return result


def external_csv_table(
    spark: SparkSession, name: str, location: str, schema: T.StructType
) -> DataFrame:
    """Drop and recreate a table over the CSV files of ``write_csv``; returns its rows. Other
    readers of the table see line breaks and backslashes in text escaped."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = ", ".join(f"{k} {_sql_text(v)}" for k, v in CSV_OPTIONS.items())
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING csv OPTIONS ({options}) "
        f"LOCATION {_sql_text(location)}"
    )
    return unescaped_lines(spark.read.table(name))


def _sql_text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """``df`` itself, or an error if it has no rows. Looks at one row only."""
    if df.isEmpty():
        raise EmptySource(f"{what} has no rows")
    return df
