"""Which staged files are good, which must be checked, which fetched again?

Files, manifest and ledger are joined on the file's base name. Each side is
reduced to one row per name first, so no name can be hot, and no side is forced
into a broadcast: Spark picks one only below its own size threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.sources.manifest import manifest_by_name
from palimpsest.sources.staged_files import Opener, digest_paths

VERIFIED = "verified"
MISMATCH = "mismatch"
UNLISTED = "unlisted"
CONFLICT = "conflict"
TRUSTED = "trusted"


def verify(digests: DataFrame, manifest: DataFrame) -> DataFrame:
    """``digests`` (``name``, ``md5``, ...) with a ``status`` against the manifest.

    ``unlisted``: the manifest has no such name; ``conflict``: it names it with
    several hashes.
    """
    listed = manifest_by_name(manifest).select(
        "name", F.col("md5").alias("listed_md5"), F.lit(True).alias("listed")
    )
    status = (
        F.when(F.col("listed").isNull(), UNLISTED)
        .when(F.col("listed_md5").isNull(), CONFLICT)
        .when(F.col("listed_md5") == F.col("md5"), VERIFIED)
        .otherwise(MISMATCH)
    )
    joined = digests.join(listed, "name", "left")
    return joined.select(*digests.columns, status.alias("status"))


def unverified(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files still to be checked: not in the ledger."""
    return files.join(ledger.select("name").distinct(), "name", "left_anti")


def trusted(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files verified in an earlier run: in the ledger."""
    return files.join(ledger.select("name").distinct(), "name", "left_semi")


def verify_unless_trusted(
    listing: DataFrame, manifest: DataFrame, ledger: DataFrame, opener: Opener | None = None
) -> DataFrame:
    """Status of every listed file; only files outside the ledger are read, by ``opener``."""
    checked = verify(digest_paths(unverified(listing, ledger), opener), manifest)
    known = trusted(listing, ledger).withColumn("status", F.lit(TRUSTED))
    columns = ["name", "path", "status"]
    return known.select(*columns).unionByName(checked.select(*columns))


def good_files(verified: DataFrame) -> DataFrame:
    return verified.where(F.col("status").isin(VERIFIED, TRUSTED))


def refetch_list(wanted: DataFrame, verified: DataFrame) -> DataFrame:
    """Wanted files that are not staged, or staged but not good."""
    good = good_files(verified).select("name").distinct()
    return wanted.distinct().join(good, "name", "left_anti")
