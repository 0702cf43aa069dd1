"""CSV without loss: one set of options for writers, readers and external tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payrisk.functions.values import TIME_FORMAT

CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "\\N",
    "timestampFormat": TIME_FORMAT,
}
#: Characters that would end or blur a line, and how they are written. The backslash comes first.
_ESCAPES = [("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")]


def _escape(column: Column) -> Column:
    for plain, written in _ESCAPES:
        column = F.replace(column, F.lit(plain), F.lit(written))
    return column


def _unescape(column: Column) -> Column:
    """Escaped backslashes are set apart first: what follows them is ordinary text."""
    parts = F.split(column, r"\\\\", -1)
    plain = F.transform(
        parts,
        lambda p: F.replace(
            F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")
        ),
    )
    return F.when(column.isNotNull(), F.array_join(plain, "\\"))


def _mapped(df: DataFrame, change) -> DataFrame:
    return df.select(
        *[
            change(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else f.name
            for f in df.schema.fields
        ]
    )


def escaped_lines(df: DataFrame) -> DataFrame:
    """Text columns with backslashes and line breaks escaped."""
    return _mapped(df, _escape)


def unescaped_lines(df: DataFrame) -> DataFrame:
    """The inverse of ``escaped_lines``."""
    return _mapped(df, _unescape)
