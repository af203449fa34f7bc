"""Rounds of verifying and fetching again, until no wanted file is missing.

A round looks only at what is still missing: staged files of those names are hashed,
those that are good go to the ledger and off the list, and ``fetch`` is asked for the
rest. The list shrinks; files found good in an earlier round, or an earlier run, are
neither listed against the manifest nor opened again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.operators import integrity
from palimpsest.sources.manifest import append_to_ledger, read_ledger
from palimpsest.sources.staged_files import Opener, digest_paths, list_staged
from palimpsest.workspace import new_location


@dataclass(frozen=True)
class Refetched:
    """``missing``: names that are still not good; ``rounds``: name, round and status of what was hashed."""

    missing: DataFrame
    rounds: DataFrame
    complete: bool


def refetch_until_complete(
    spark: SparkSession,
    wanted: DataFrame,
    manifest: DataFrame,
    staged: str,
    ledger_path: str,
    fetch: Callable[[DataFrame, int], bool | None],
    most_rounds: int = 10,
    glob: str | None = None,
    name: Column | None = None,
    opener: Opener | None = None,
) -> Refetched:
    """Verify, fetch what is missing, and again.

    ``fetch`` gets the missing names and the number of the round (from 1), and brings
    files below ``staged``, over earlier ones of their name; it returns False if nothing
    more will come. Ends when nothing is missing, ``fetch`` gives up, or after
    ``most_rounds``.
    """
    if most_rounds < 1:
        raise ValueError("most_rounds must be at least 1")

    def kept(frame: DataFrame, purpose: str) -> DataFrame:
        where = new_location(spark, purpose)
        frame.write.parquet(where)
        return spark.read.schema(frame.schema).parquet(where)

    missing = kept(integrity.unverified(wanted.select("name").distinct(), read_ledger(spark, ledger_path)), "missing")
    rounds = None
    for number in range(1, most_rounds + 1):
        arrived = list_staged(spark, staged, glob, name).join(missing, "name", "left_semi")
        listed = manifest.join(missing, "name", "left_semi")
        status = integrity.verify(digest_paths(arrived, opener), listed)
        checked = kept(status.select("name", F.lit(number).alias("round"), "status"), "round")
        rounds = checked if rounds is None else rounds.unionByName(checked)
        good = integrity.good_files(checked).select("name").distinct()
        append_to_ledger(good, ledger_path)
        missing = kept(missing.join(good, "name", "left_anti"), "missing")
        if missing.isEmpty():
            return Refetched(missing, rounds, True)
        if number == most_rounds or fetch(missing, number) is False:
            break
    return Refetched(missing, rounds, False)
