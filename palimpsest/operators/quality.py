"""Checks on revision rows: malformed input, required fields, unique ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from palimpsest.operators.unique import repeated_numbers
from palimpsest.schemas import FIELDS, REQUIRED


class DuplicateRevision(Exception):
    """A revision id occurs more than once."""


class MissingValue(Exception):
    """A required field is null."""


def revisions_or_fail(rows: DataFrame) -> DataFrame:
    """The revisions; a row that is none fails the job.

    The failure sits in a filter, so it does not depend on which columns the
    query goes on to read.
    """
    message = F.concat_ws(" in ", F.concat(F.lit("malformed input: "), "problem"), "file_path")
    sound = F.when(F.col("problem").isNull(), F.lit(True)).otherwise(
        F.raise_error(message).cast("boolean")
    )
    return rows.where(sound)


def sound_rows(rows: DataFrame) -> DataFrame:
    return rows.where("problem is null")


def quarantined_rows(rows: DataFrame) -> DataFrame:
    """Rows that are no revision, with the reason and what is left of their XML."""
    return rows.where("problem is not null")


def null_violations(rows: DataFrame, required: list[str] = REQUIRED) -> DataFrame:
    """``field``, ``violations``: how many rows miss each required field."""
    counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counts.unpivot([], required, "field", "violations")


def required_or_fail(rows: DataFrame, required: list[str] = REQUIRED) -> DataFrame:
    """The rows; a null in a required field fails the job."""

    def checked(name: str):
        failure = F.raise_error(F.lit(f"{name} is null"))
        return F.when(F.col(name).isNotNull(), F.col(name)).otherwise(failure).alias(name)

    return rows.select(*[checked(c) if c in required else F.col(c) for c in rows.columns])


def duplicate_ids(rows: DataFrame, key: str = "id") -> DataFrame:
    """``key``, ``copies`` of every key held by several rows.

    Whole numbers are packed before they are shuffled (``repeated_numbers``).
    """
    if isinstance(rows.schema[key].dataType, IntegralType):
        return repeated_numbers(rows, key)
    return rows.groupBy(key).agg(F.count("*").alias("copies")).where("copies > 1")


def check_loaded(rows: DataFrame) -> int:
    """Raise if required fields are null or ids repeat; returns the number of rows.

    Reads those columns only. Rows and nulls are counted in one pass.
    """
    nulls = [F.count_if(F.col(c).isNull()).alias(c) for c in REQUIRED]
    found = rows.agg(F.count(F.lit(1)).alias("rows"), *nulls).first()
    missing = [f"{c}: {found[c]}" for c in REQUIRED if found[c]]
    if missing:
        raise MissingValue(", ".join(missing))
    repeated = duplicate_ids(rows).take(1)
    if repeated:
        raise DuplicateRevision(f"revision {repeated[0]['id']}: {repeated[0]['copies']} rows")
    return found["rows"]


def fields_only(rows: DataFrame) -> DataFrame:
    """The 11 public fields in their public order."""
    return rows.select(*FIELDS)
