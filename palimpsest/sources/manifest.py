"""Checksum manifests and the ledger of verified files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions.values import strip

# Fixed value: what stands between hash and name on a manifest line.
SEPARATOR = "  "


def read_manifest(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_manifest(spark.read.text(path))


def parse_manifest(lines: DataFrame) -> DataFrame:
    """``value`` lines to ``md5``, ``name``; a line of another form fails the job."""
    parts = F.split("value", SEPARATOR)
    message = F.concat(F.lit("not a manifest line: "), F.col("value"))
    name = F.when(F.size(parts) > 1, strip(F.try_element_at(parts, F.lit(2)))).otherwise(
        F.raise_error(message).cast("string")
    )
    return lines.select(F.element_at(parts, 1).alias("md5"), name.alias("name"))


def manifest_by_name(manifest: DataFrame) -> DataFrame:
    """One row per name; ``md5`` is null where its lines disagree.

    Spark gives lines no order across files, so "the last line wins" has no
    meaning here; a contradiction is shown instead.
    """
    low, high = F.min("md5"), F.max("md5")
    return manifest.groupBy("name").agg(F.when(low == high, high).alias("md5"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Names verified in earlier runs, one row each; none if there is no ledger yet."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "name string")
    return lines.select(strip(F.col("value")).alias("name")).where("name <> ''").distinct()


def append_to_ledger(names: DataFrame, path: str) -> None:
    """Record names; a ledger that does not exist yet is created."""
    names.select("name").distinct().write.mode("append").text(path)


def clear_ledger(spark: SparkSession, path: str) -> None:
    spark.createDataFrame([], "name string").write.mode("overwrite").text(path)
