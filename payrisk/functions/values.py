"""Column expressions shared by the jobs. All are built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters a text trim removes (all Unicode whitespace).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Country spellings and the code each one stands for.
COUNTRY_ALIASES = {"ESPAÑA": "ES", "SPAIN": "ES", "ES": "ES"}
UNKNOWN_COUNTRY = "UNKNOWN"

# The share of train rows, as the first two hex digits of the id's MD5 (0xcd / 256).
TRAIN_BELOW_HEX = "cd"


def stripped(column: Column) -> Column:
    """Text without leading and trailing whitespace of any kind; null stays null."""
    return F.btrim(column.cast("string"), F.lit(WHITESPACE))


#: How times are written into JSON: every microsecond, with the zone.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def event_instant(df: DataFrame, name: str) -> Column:
    """Time from a column of ISO text; unreadable text gives null instead of an error. A column of
    timestamps stays as it is, so filters on it reach the scan."""
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return F.col(name)
    return F.try_to_timestamp(F.col(name).cast("string"))


def epoch_second(column: Column) -> Column:
    """Whole epoch seconds. Window frames compare these, so fractions of a second are cut off."""
    return F.unix_seconds(column)


def number_or_null(column: Column) -> Column:
    """Double from text; anything that is not a plain finite or infinite number gives null.

    Spark's cast also reads Java's ``1.5d`` and ``1.5f`` and yields NaN for ``nan``. Neither is a
    usable amount, and NaN compares greater than every number, so both become null.
    """
    text = column.cast("string")
    value = F.when(~text.rlike(r"[dDfF]\s*$") | text.rlike(r"(?i)inf\s*$"), text.try_cast("double"))
    return F.when(~F.isnan(value), value)


def country_code(column: Column) -> Column:
    """Upper-case country code with the known spellings unified and 'unknown' as null."""
    code = F.upper(stripped(column))
    unified = F.when(code == UNKNOWN_COUNTRY, F.lit(None).cast("string"))
    for spelling, target in COUNTRY_ALIASES.items():
        unified = unified.when(code == spelling, F.lit(target))
    return unified.otherwise(code)


def time_parts(column: Column, granularity: str) -> dict[str, Column]:
    """Zero-padded text partition columns from the year down to ``granularity``."""
    patterns = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH", "minute": "mm"}
    names = list(patterns)
    if granularity not in names:
        raise ValueError(f"granularity must be one of {names}")
    wanted = names[: names.index(granularity) + 1]
    return {name: F.date_format(column, patterns[name]) for name in wanted}


def is_train(key: Column) -> Column:
    """True for about 80 % of keys. Depends on the key alone, not on row order or partitioning."""
    return F.substring(F.md5(key.cast("binary")), 1, 2) < TRAIN_BELOW_HEX
