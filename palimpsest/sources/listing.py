"""Dump listings: which history files does a dump have?"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions import links


def read_listing(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Saved listing pages, one row per page: ``html``."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("html"))


def listing_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per ``href`` of each page; the page's other columns are kept."""
    others = [F.col(c) for c in pages.columns if c != html]
    return pages.select(*others, F.explode(links.hrefs(F.col(html))).alias("url"))


def history_links(
    listing: DataFrame,
    needle: str = links.HISTORY_NEEDLE,
    suffix: str = links.HISTORY_SUFFIX,
) -> DataFrame:
    """The distinct links that name history files."""
    wanted = listing.where(links.is_history_link(F.col("url"), needle, suffix))
    return wanted.select("url").distinct()


def wanted_files(listing: DataFrame, date: str, **site: str) -> DataFrame:
    """History files of a dump: ``url`` and base ``name``, one row each."""
    resolved = history_links(listing).select(links.full_url(F.col("url"), date, **site).alias("url"))
    return resolved.select("url", links.base_name(F.col("url")).alias("name"))
