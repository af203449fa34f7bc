"""Column expressions over revision values: casts, null rules, sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a text strip removes, and the estimate for the small fields.
WHITESPACE = " \t\n\r\x0b\x0c"
ROW_OVERHEAD_BYTES = 300
# Fixed value: date and time of ISO-8601, to the second or finer, with a zone.
INSTANT = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?(Z|[+-]\d\d:?\d\d)\z"


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITESPACE))


def empty_as_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def row_size(text: Column, comment: Column) -> Column:
    """Estimated bytes of a revision: its UTF-8 text and comment, and a constant."""
    return (
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
        + F.coalesce(F.octet_length(comment), F.lit(0))
        + F.lit(ROW_OVERHEAD_BYTES)
    )


def to_integer(value: Column, type_name: str = "bigint") -> Column:
    """Whole number, or null if the text is not one."""
    return value.try_cast(type_name)


def to_instant(value: Column) -> Column:
    """Instant of an ISO-8601 date and time with its zone, or null if it is not one.

    Without the check Spark would complete a bare year, or a bare time with today's date.
    """
    return F.when(value.rlike(INSTANT), F.try_to_timestamp(value))


def or_fail(converted: Column, original: Column, name: str) -> Column:
    """``converted``, failing the job where a value was there but did not convert."""
    message = F.concat(F.lit(f"bad {name}: "), original)
    failure = F.raise_error(message)
    return F.when(converted.isNull() & original.isNotNull(), failure).otherwise(converted)
