"""Page-history dumps to a verified, typed revision table, on Spark."""

from palimpsest.operators.batching import assign_batches, batch_summary
from palimpsest.operators.counts import revision_counts, revisions_per_page
from palimpsest.operators.integrity import (
    refetch_list,
    trusted,
    unverified,
    verify,
    verify_unless_trusted,
)
from palimpsest.operators.provenance import with_provenance
from palimpsest.operators.quality import (
    duplicate_ids,
    fields_only,
    null_violations,
    quarantined_rows,
    required_or_fail,
    revisions_or_fail,
    sound_rows,
)
from palimpsest.operators.retype import retype, retype_leniently
from palimpsest.plans.ingest import Ingested, ingest_dump
from palimpsest.plans.refetch import Refetched, refetch_until_complete
from palimpsest.schemas import FIELDS, RAW_SCHEMA, REQUIRED, TYPED_SCHEMA
from palimpsest.sinks import write_revisions
from palimpsest.sinks.database import abandon_load, read_database, write_database
from palimpsest.sinks.tables import forgotten_folders, load_dump, recover_table
from palimpsest.sources.history import read_history, stage_history, staged_history, unclosed_files
from palimpsest.sources.listing import history_links, listing_links, read_listing, wanted_files
from palimpsest.sources.manifest import append_to_ledger, clear_ledger, read_ledger, read_manifest
from palimpsest.sources.staged_files import digest_staged, list_staged
from palimpsest.streaming.ingest import live_csv, proven_files, remove_taken, stream_history, streamed_history
from palimpsest.workspace import remove_location

__all__ = [
    "FIELDS",
    "RAW_SCHEMA",
    "REQUIRED",
    "TYPED_SCHEMA",
    "Ingested",
    "Refetched",
    "abandon_load",
    "append_to_ledger",
    "assign_batches",
    "batch_summary",
    "clear_ledger",
    "digest_staged",
    "duplicate_ids",
    "fields_only",
    "forgotten_folders",
    "history_links",
    "ingest_dump",
    "list_staged",
    "listing_links",
    "live_csv",
    "load_dump",
    "null_violations",
    "proven_files",
    "quarantined_rows",
    "read_database",
    "read_history",
    "read_ledger",
    "read_listing",
    "read_manifest",
    "recover_table",
    "refetch_list",
    "refetch_until_complete",
    "remove_location",
    "remove_taken",
    "required_or_fail",
    "retype",
    "retype_leniently",
    "revision_counts",
    "revisions_or_fail",
    "revisions_per_page",
    "sound_rows",
    "stage_history",
    "staged_history",
    "stream_history",
    "streamed_history",
    "trusted",
    "unclosed_files",
    "unverified",
    "verify",
    "verify_unless_trusted",
    "wanted_files",
    "with_provenance",
    "write_database",
    "write_revisions",
]
