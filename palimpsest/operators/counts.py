"""How many revisions are there, per file and in all?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def revision_counts(rows: DataFrame, file: str = "file_name") -> DataFrame:
    """``file``, ``revisions``; the row with a null file is the total.

    Rows are counted per file first, so the rollup expands one row per file
    rather than every revision.
    """
    per_file = rows.groupBy(F.col(file).alias("file")).agg(F.count("*").alias("n"))
    return per_file.rollup("file").agg(F.sum("n").alias("revisions"))


def revisions_per_page(rows: DataFrame) -> DataFrame:
    """``page_id``, ``page_title``, ``revisions``."""
    return rows.groupBy("page_id", "page_title").agg(F.count("*").alias("revisions"))
