"""From a dump's listing, manifest and staged files to typed revisions."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession

from palimpsest.operators import integrity, quality
from palimpsest.operators.retype import retype
from palimpsest.sources.history import (
    no_records, read_records, stage_history, staged_history, unclosed_files,
)
from palimpsest.sources.manifest import append_to_ledger, read_ledger
from palimpsest.schemas import FIELDS
from palimpsest.sources.staged_files import Opener, digest_staged, list_staged
from palimpsest.workspace import new_location

FILES_TOGETHER = 10_000


@dataclass(frozen=True)
class Ingested:
    """What one run found: rows, set-aside rows and the state of the files."""

    revisions: DataFrame
    quarantined: DataFrame
    files: DataFrame
    refetch: DataFrame
    #: The revisions as the dump's own strings, for CSV.
    raw: DataFrame
    #: Files that end before their root element does.
    unclosed: DataFrame
    #: Folders these frames read; ``remove_location`` deletes each when done with.
    staging: tuple[str, ...]


def ingest_dump(
    spark: SparkSession,
    wanted: DataFrame,
    manifest: DataFrame,
    staged: str,
    ledger: DataFrame | None = None,
    ledger_path: str | None = None,
    glob: str | None = None,
    name: Column | None = None,
    quarantine: bool = False,
    strict_elements: bool = False,
    require_all: bool = False,
    opener: Opener | None = None,
    columns: list[str] | None = None,
    namespaces: list[str | int] | None = None,
    files_together: int = FILES_TOGETHER,
) -> Ingested:
    """Verify the staged files, then read those that are wanted and good.

    ``wanted`` has a ``name`` per file of the dump. Files in ``ledger``, or in the
    one at ``ledger_path`` if there is one, are trusted without reading them; the
    names verified now are added there. Unless ``quarantine`` is set, malformed
    input and files that end early fail the job. ``require_all`` fails it if a
    wanted file is missing or not good. Two staged files of one name always do.
    ``opener`` opens files for their digests. With ``namespaces`` only revisions of these
    pages are parsed, with ``columns`` only these fields, and then ``revisions`` and
    ``raw`` have no others. Files are staged ``files_together`` at a time.
    """
    if ledger is None and ledger_path is not None:
        ledger = read_ledger(spark, ledger_path)
    if ledger is None:
        status = integrity.verify(digest_staged(spark, staged, glob, name, opener), manifest)
    else:
        listing = list_staged(spark, staged, glob, name)
        status = integrity.verify_unless_trusted(listing, manifest, ledger, opener)
    # Hashing reads every file, so its outcome is kept: one row per file.
    files_at = new_location(spark, "file-status")
    status.select("name", "path", "status").write.parquet(files_at)
    files = spark.read.parquet(files_at)

    twice = files.groupBy("name").count().where("count > 1").select("name").take(5)
    if twice:
        raise ValueError(f"staged more than once: {', '.join(row.name for row in twice)}")
    refetch = integrity.refetch_list(wanted.select("name"), files)
    missing = refetch.take(5) if require_all else []
    if missing:
        raise ValueError(f"wanted files not staged or not good: {', '.join(r.name for r in missing)}")
    good = integrity.good_files(files).join(wanted.select("name").distinct(), "name", "left_semi")
    rows_at = new_location(spark, "history")
    chosen = {"columns": columns, "namespaces": namespaces}
    # The reader takes paths from the driver: so many at a time.
    number = 0
    for number, paths in enumerate(_together(good, files_together), 1):
        stage_history(read_records(spark, paths), rows_at, part=f"batch={number}", **chosen)
    if not number:  # without good files there are no rows, and the refetch list says what to fetch
        stage_history(no_records(spark), rows_at, part="batch=0", **chosen)
    rows = staged_history(spark, rows_at, strict_elements, columns=columns)
    unclosed = unclosed_files(spark, rows_at)
    early = [] if quarantine else unclosed.take(5)
    if early:
        raise ValueError(f"files that end early: {', '.join(row.file_name for row in early)}")
    if ledger_path is not None:
        append_to_ledger(files.where(f"status = '{integrity.VERIFIED}'"), ledger_path)
    raw = quality.sound_rows(rows) if quarantine else quality.revisions_or_fail(rows)
    fields = raw.select(*[c for c in FIELDS if columns is None or c in columns])
    return Ingested(
        revisions=retype(fields),
        quarantined=quality.quarantined_rows(rows),
        files=files,
        refetch=refetch,
        raw=fields,
        unclosed=unclosed,
        staging=(rows_at, files_at),
    )


def _together(files: DataFrame, size: int) -> Iterator[list[str]]:
    """Paths in order, a list of ``size`` at a time on the driver."""
    paths = (as_literal(row.path) for row in files.select("path").orderBy("path").toLocalIterator())
    while held := list(islice(paths, size)):
        yield held


def as_literal(path: str) -> str:
    """The path with what file globs would read otherwise escaped."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)
