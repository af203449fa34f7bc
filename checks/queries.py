"""One query per operator, each over whole tables or files written from them."""

from __future__ import annotations

import os
import sqlite3
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import dumps
from palimpsest.functions import links, values
from palimpsest.operators import batching, counts, integrity, quality
from palimpsest.operators.provenance import with_provenance
from palimpsest.operators.retype import retype, retype_leniently
from palimpsest.plans.ingest import ingest_dump
from palimpsest.plans.refetch import refetch_until_complete
from palimpsest.schemas import FIELDS, REQUIRED
from palimpsest.sinks import tables, write_revisions
from palimpsest.sinks.csv_files import read_csv, read_parallel_csv
from palimpsest.sinks.database import read_database
from palimpsest.sinks.jdbc import read_jdbc
from palimpsest.sources import history, listing, manifest, staged_files
from palimpsest.streaming import ingest
from palimpsest.streaming.ingest import stream_history, streamed_history
from palimpsest.workspace import new_location

JDBC_URL = "spark.palimpsest.jdbc.url"


def _scanned(spark: SparkSession, sf_dir: str, **chosen) -> DataFrame:
    """Revisions read from the dump written from ``conversations``."""
    rows = history.read_history(spark, dumps.history_path(spark, sf_dir), **chosen)
    return quality.revisions_or_fail(rows)


def _with_epoch(rows: DataFrame) -> DataFrame:
    """Typed rows with the instant as seconds, which no session zone changes."""
    others = [c for c in FIELDS if c != "timestamp"]
    return rows.select(*others, F.unix_seconds("timestamp").alias("epoch"))


# ------------------------------------------------------------------ listings


def listing_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = dumps.table(spark, sf_dir, "pages").select("page_id", "html")
    return listing.listing_links(pages)


def link_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = listing.listing_links(dumps.table(spark, sf_dir, "pages").select("html"))
    return listing.history_links(found, needle="th", suffix="e")


def url_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    rooted = listing_links(spark, sf_dir).select("url").distinct()
    bare = rooted.select(F.expr("ltrim('/', url)").alias("url"))
    url = F.col("url")
    return rooted.unionByName(bare).distinct().select(
        "url",
        links.full_url(url, "20200101", on_unexpected="null").alias("dated"),
        links.full_url(url, "latest", on_unexpected="null").alias("latest"),
    )


def dump_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = dumps.table(spark, sf_dir, "orders").select("o_orderdate").distinct()
    date = F.date_format("o_orderdate", "yyyyMMdd")
    return days.select(date.alias("date")).distinct().select(
        "date",
        links.dump_page_url(F.col("date")).alias("dump_page"),
        links.manifest_url(F.col("date")).alias("manifest"),
        links.full_url(F.lit("/enwiki/a.bz2"), F.col("date")).alias("file_url"),
    )


def basename(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = dumps.table(spark, sf_dir, "pages")
    return pages.select("page_id", links.base_name(F.col("url")).alias("name"))


# ----------------------------------------------------------------- integrity


def manifest_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = dumps.table(spark, sf_dir, "documents")
    path = new_location(spark, "manifest")
    documents.select(
        F.concat(F.md5(F.encode("text", "utf-8")), F.lit("  doc-"), "doc_id", F.lit(".txt "))
    ).write.text(path)
    return manifest.read_manifest(spark, path)


def _staged_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = dumps.staged_documents(spark, sf_dir)
    name = dumps.staged_name(F.col("path"))
    return staged_files.digest_staged(spark, path, glob="*.txt", name=name)


def _file_number():
    return F.regexp_extract("name", "([0-9]+)[.]txt", 1).cast("long")


def _manifest_of(digests: DataFrame) -> DataFrame:
    """A manifest of the files: by number, some hashes wrong, absent or contradictory."""
    rule = _file_number() % 5
    right, wrong = F.col("md5"), F.md5(F.lit("other").cast("binary"))
    lines = (
        F.when(rule == 1, F.array(wrong))
        .when(rule == 2, F.array().cast("array<string>"))
        .when(rule == 3, F.array(right, wrong))
        .otherwise(F.array(right))
    )
    return digests.select("name", F.explode(lines).alias("md5"))


def checksum_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    digests = _staged_digests(spark, sf_dir).select("name", "md5")
    return integrity.verify(digests, _manifest_of(digests))


def trusted_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = dumps.staged_documents(spark, sf_dir)
    name = dumps.staged_name(F.col("path"))
    listed = staged_files.list_staged(spark, path, glob="*.txt", name=name)
    earlier = F.when(_file_number() % 2 == 1, F.array("name"))
    ledger = listed.select(F.explode(earlier).alias("name"))
    manifest_lines = _manifest_of(_staged_digests(spark, sf_dir))
    return integrity.verify_unless_trusted(listed, manifest_lines, ledger).select("name", "status")


def refetch_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = dumps.file_count(dumps.table(spark, sf_dir, "documents"), 10)
    wanted = spark.range(files + 3).select(
        F.format_string("pages-meta-history%s.txt", F.col("id").cast("string")).alias("name")
    )
    return integrity.refetch_list(wanted, checksum_verify(spark, sf_dir))


def refetch_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the staged files a quarter is there, one comes damaged and then right, one unlisted, one never."""
    source = _staged_digests(spark, sf_dir)
    listed = source.select("name", "md5").where(_file_number() % 4 != 3)
    number, folder = _file_number(), new_location(spark, "arrivals")
    lines = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n")
    texts = lines.text(dumps.staged_documents(spark, sf_dir)).select(
        dumps.staged_name(F.col("_metadata.file_path")).alias("name"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value",
    )

    def bring(which, damaged: bool = False, over: bool = False) -> None:
        rows = texts.where(which)
        if damaged:
            first = {"block": F.lit(-1).cast("long"), "at": F.lit(-1).cast("long"), "value": F.lit("damaged")}
            rows = rows.unionByName(rows.select("name").distinct().withColumns(first))
        in_order = rows.repartition("name").sortWithinPartitions("name", "block", "at").select("name", "value")
        writer = in_order.write.partitionBy("name").mode("overwrite" if over else "append")
        writer.option("partitionOverwriteMode", "dynamic").text(folder)

    def fetch(missing: DataFrame, round_: int) -> bool:
        if round_ == 1:
            bring(number % 4 == 1, damaged=True)
        elif round_ == 2:
            bring(number % 4 == 1, over=True)
            bring(number % 4 == 3)
        return round_ < 3

    bring(number % 4 == 0)
    ledger = new_location(spark, "ledger")
    name = dumps.staged_name(F.col("path"))
    wanted = source.select("name")
    done = refetch_until_complete(spark, wanted, listed, folder, ledger, fetch, glob="*.txt", name=name)
    missing = done.missing.select("name", F.lit(None).cast("int").alias("round"), F.lit("missing").alias("status"))
    return done.rounds.select("name", "round", "status").unionByName(missing)


def ledger_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    def name(rows: DataFrame) -> DataFrame:
        return rows.select(F.concat(F.lit("doc-"), "doc_id", F.lit(".txt")).alias("name"))

    path = new_location(spark, "ledger")
    labelled = name(dumps.table(spark, sf_dir, "labels"))
    manifest.append_to_ledger(labelled, path)
    manifest.append_to_ledger(labelled, path)
    ledger = manifest.read_ledger(spark, path)
    files = name(dumps.table(spark, sf_dir, "documents"))
    check = integrity.unverified(files, ledger).withColumn("action", F.lit("check"))
    trust = integrity.trusted(files, ledger).withColumn("action", F.lit("trust"))
    return check.unionByName(trust)


# ------------------------------------------------------------------ histories


def xml_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.fields_only(_scanned(spark, sf_dir))


def contributor_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = (
        F.when(F.col("contributor_ip").isNotNull(), "anonymous")
        .when(F.col("contributor_id").isNotNull(), "account")
        .when(F.col("contributor_name").isNotNull(), "name only")
        .otherwise("removed")
    )
    rows = _scanned(spark, sf_dir, columns=["contributor_id", "contributor_name", "contributor_ip"])
    return rows.groupBy(kind.alias("kind")).agg(F.count("*").alias("revisions"))


def null_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    def state(name: str):
        value = F.col(name)
        stripped = values.strip(value)
        return (
            F.when(value.isNull(), "null")
            .when(stripped == "", "blank")
            .when(stripped != value, "padded")
            .otherwise("plain")
        ).alias(f"{name}_state")

    nullable = ["parent_id", "text", "comment", "contributor_id", "contributor_name"]
    rows = _scanned(spark, sf_dir)
    length = F.length("text").cast("long").alias("text_length")
    return rows.select("id", *[state(c) for c in nullable], length)


def malformed_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = history.read_history(spark, dumps.history_path(spark, sf_dir, "damaged"))
    kept = quality.sound_rows(rows).select("page_id", F.lit("none").alias("problem"))
    set_aside = quality.quarantined_rows(rows).select("page_id", "problem")
    return (
        kept.unionByName(set_aside)
        .groupBy("page_id", "problem")
        .agg(F.count("*").alias("revisions"))
    )


def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisions without an id or a timestamp are set aside, with the reason."""
    rows = history.read_history(spark, dumps.history_path(spark, sf_dir, "lacking"))
    problem = F.coalesce("problem", F.lit("none")).alias("problem")
    return rows.groupBy("page_id", problem).agg(
        F.count("*").alias("revisions"), F.count("id").alias("ids"),
        F.count("timestamp").alias("timestamps"),
    )


def truncated_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that end between elements, between revisions or inside an element."""
    staging = new_location(spark, "truncated")
    path = dumps.history_path(spark, sf_dir, "cut")
    rows = history.read_history(spark, path, staging=staging)
    unclosed = history.unclosed_files(spark, staging).select("file_path", F.lit(True).alias("early"))
    by_file = rows.groupBy("file_path").agg(
        F.count_if(F.col("problem").isNull()).alias("sound"),
        F.count_if(F.col("problem") == history.UNREADABLE).alias("unreadable"),
        F.count("*").alias("revisions"),
    )
    return by_file.join(unclosed, "file_path", "left").select(
        dumps.dump_file(F.col("file_path")).alias("dump_file"), "sound", "unreadable", "revisions",
        F.coalesce("early", F.lit(False)).alias("ends_early"),
    )


def split_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As xml_scan, of pages longer than a block in files cut into many blocks."""
    path = dumps.long_history_path(spark, sf_dir)
    conversations = dumps.table(spark, sf_dir, "conversations")
    size = conversations.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    # The block size is set in a session of its own: about a hundred blocks at any scale.
    apart = spark.newSession()
    apart.conf.set("spark.sql.files.maxPartitionBytes", max(4_000, size // 100))
    apart.conf.set("spark.sql.files.openCostInBytes", 1)
    staging = new_location(spark, "split")
    history.stage_history(history.read_records(apart, path), staging)
    return quality.fields_only(quality.revisions_or_fail(history.staged_history(spark, staging)))


def revisions_per_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.revisions_per_page(_scanned(spark, sf_dir, columns=["page_id", "page_title"]))


def revision_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scanned(spark, sf_dir, columns=[])
    return counts.revision_counts(rows.select(dumps.dump_file(F.col("file_path")).alias("dump_file")), "dump_file")


def namespace_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some fields of the revisions of two namespaces; others are not parsed."""
    chosen = ["id", "comment", "page_id", "page_ns", "contributor_name"]
    return _scanned(spark, sf_dir, columns=chosen, namespaces=[0, 2]).select(*chosen)


def multi_file_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = dumps.history_path(spark, sf_dir)
    files = dumps.file_count(dumps.table(spark, sf_dir, "conversations"), 4)
    halves = [
        history.read_history(spark, [f"{path}/file={k}" for k in range(half, files, 2)])
        for half in (0, 1)
    ]
    rows = quality.revisions_or_fail(halves[0].unionByName(halves[1]))
    return rows.select(dumps.dump_file(F.col("file_path")).alias("dump_file"), "id", "page_id")


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = new_location(spark, "stream")
    query = stream_history(
        spark, dumps.history_path(spark, sf_dir), staging, new_location(spark, "stream-state"),
        glob="*.bz2",
    )
    query.awaitTermination()
    return quality.fields_only(quality.revisions_or_fail(streamed_history(spark, staging)))


def live_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a stream's batches as CSV, read back; the first batch is replayed."""
    staging, csv = new_location(spark, "stream"), new_location(spark, "live-csv")
    path = dumps.history_path(spark, sf_dir)
    for state, files in (("first", 1), ("all", 1)):  # a fresh checkpoint sends the same batches again
        stream_history(
            spark, path, staging, new_location(spark, f"stream-{state}"), files_per_batch=files, glob="*.bz2",
            on_batch=ingest.live_csv(csv),
        ).awaitTermination()
    return read_parallel_csv(spark, csv).select(*FIELDS)


def clean_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a dump with damaged pages and one with whole ones: which files stay after a stream."""
    folder, staging, state = (new_location(spark, x) for x in ("taken", "stream", "stream-state"))
    conversations = dumps.table(spark, sf_dir, "conversations")
    files = dumps.file_count(conversations, 4)
    for kind in ("whole", "damaged"):
        dumps.write_history(conversations, f"{folder}/kind={kind}", files, **({"damaged": True} if kind == "damaged" else {}))
    stream_history(spark, folder, staging, state, glob="*.bz2").awaitTermination()
    before = staged_files.list_staged(spark, folder, glob="*.bz2").select("path")
    listed = new_location(spark, "listed")
    before.write.parquet(listed)
    ingest.remove_taken(spark, staging, state)
    ingest.remove_taken(spark, staging, state)
    after = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    left = after.where(F.col("path").endswith(".bz2")).withColumn("left", F.lit(True))
    kind = F.regexp_extract("path", "/kind=([a-z]+)/", 1).alias("kind")
    return spark.read.parquet(listed).join(left, "path", "left").select(
        kind, dumps.dump_file(F.col("path")).alias("dump_file"), F.coalesce("left", F.lit(False)).alias("stays")
    )


# --------------------------------------------------------------------- values


def retype_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = dumps.table(spark, sf_dir, "conversations").selectExpr(
        "conv_id",
        "turn",
        """CASE (conv_id + turn) % 10 WHEN 0 THEN concat('x', turn) WHEN 1 THEN concat(' ', turn, ' ')
           WHEN 2 THEN concat('-', turn) WHEN 3 THEN concat(turn, '.5') ELSE cast(turn AS string)
           END AS id""",
        "CASE WHEN turn > 0 THEN cast(turn - 1 AS string) END AS parent_id",
        """CASE turn % 4 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN concat(conv_id, 'a')
           ELSE cast(conv_id AS string) END AS contributor_id""",
        "role AS contributor_name",
        "cast(NULL AS string) AS contributor_ip",
        """CASE conv_id % 6 WHEN 0 THEN 'November 5 2019' WHEN 1 THEN '2019-11-05T07:41:09+02:00'
           WHEN 2 THEN concat('2019-11-05T07:41:09Z', char(10)) ELSE '2019-11-05T07:41:09Z' END AS timestamp""",
        "text",
        "cast(NULL AS string) AS comment",
        "cast(conv_id AS string) AS page_id",
        "concat('c', conv_id) AS page_title",
        "CASE WHEN conv_id % 8 = 0 THEN '99999999999' ELSE cast(conv_id % 3 AS string) END AS page_ns",
    )
    return retype_leniently(raw).select(
        "conv_id", "turn", "id", "parent_id", "contributor_id",
        F.unix_seconds("timestamp").alias("epoch"), "page_id", "page_ns",
        F.concat_ws(",", F.sort_array("rejected")).alias("rejected"),
    )


def row_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = dumps.table(spark, sf_dir, "documents")
    size = values.row_size(F.col("text"), F.col("source"))
    return documents.select("doc_id", size.alias("size"))


def not_null_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = dumps.raw_revisions(dumps.table(spark, sf_dir, "conversations"))
    page, n = F.col("page_id").cast("long"), F.col("id").cast("long")
    holes = {"timestamp": page % 5 == 0, "page_title": n % 4 == 0, "page_ns": page % 9 == 2}
    holed = raw.select(
        *[F.when(~holes[c], F.col(c)).alias(c) if c in holes else F.col(c) for c in raw.columns]
    )
    return quality.null_violations(retype(holed), REQUIRED)


def pk_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = dumps.table(spark, sf_dir, "conversations")
    copies = F.when(F.col("conv_id") % 5 == 0, 2 + F.col("turn") % 2).otherwise(1)
    repeated = conversations.select(
        F.expr(dumps.REVISIONS["id"]).alias("id"), F.explode(F.sequence(F.lit(1), copies))
    )
    return quality.duplicate_ids(repeated)


def size_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = dumps.table(spark, sf_dir, "conversations")
    sized = conversations.select(
        (F.col("conv_id") % 4).alias("file"), "conv_id", "turn",
        values.row_size(F.col("text"), F.lit(None).cast("string")).alias("size"),
    )
    batches = batching.assign_batches(sized, "file", ["conv_id", "turn"], "size", 20_000)
    return batching.batch_summary(batches, "file")


# ---------------------------------------------------------------------- sinks


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_location(spark, "csv")
    write_revisions(_scanned(spark, sf_dir), "csv", path)
    return read_csv(spark, path)


def csv_parallel(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_location(spark, "parallel-csv")
    write_revisions(_scanned(spark, sf_dir), "parallel_csv", path)
    return read_parallel_csv(spark, path)


def jdbc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Needs a database that all executors reach, named in ``spark.palimpsest.jdbc.url``.

    In local mode alone, where driver and executors are one process, Derby's
    in-memory database does: it lives in that process and opens no port.
    """
    url = spark.conf.get(JDBC_URL, None)
    if url is None:
        if not spark.conf.get("spark.master", "").startswith(("local[", "local,")) and (
            spark.conf.get("spark.master", "") != "local"
        ):
            raise ValueError(f"set {JDBC_URL} to a database that the executors can reach")
        url = f"jdbc:derby:memory:revisions{uuid.uuid4().hex};create=true"
    table = f"revisions_{uuid.uuid4().hex[:12]}"
    write_revisions(retype(_scanned(spark, sf_dir)), "jdbc", url, table)
    ids = dumps.table(spark, sf_dir, "conversations").select(F.expr(dumps.REVISIONS["id"]).alias("id"))
    bounds = ids.agg(F.min("id"), F.max("id")).first()
    return _with_epoch(read_jdbc(spark, url, table, partitions=4, id_range=tuple(bounds)))


def _database(spark: SparkSession) -> partial:
    """A new SQLite file in the shared folder, which all tasks open."""
    path = new_location(spark, "database")
    folder = "/" + path.removeprefix("file:").lstrip("/")
    if not path.startswith(("/", "file:")):
        raise ValueError(f"SQLite needs a folder that is mounted, not {path}")
    os.makedirs(folder)
    return partial(sqlite3.connect, f"{folder}/base.db", timeout=600)


def database_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements with many rows, commits of at most 200 kB; read back by ranges of ids."""
    connect = _database(spark)
    rows = retype(_scanned(spark, sf_dir))
    write_revisions(rows, "database", connect, "revisions", multiple_values=True, commit_bytes=200_000)
    ids = dumps.table(spark, sf_dir, "conversations").select(F.expr(dumps.REVISIONS["id"]).alias("id"))
    bounds = ids.agg(F.min("id"), F.max("id")).first()
    return _with_epoch(read_database(spark, connect, "revisions", tuple(bounds)))


def database_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that loses its connections half way, and a second run that takes it up."""

    class Lost(sqlite3.Connection):
        """Its second transaction fails."""

        taken = 0

        def commit(self) -> None:
            if self.taken:
                raise sqlite3.OperationalError("connection lost")
            self.taken += 1
            super().commit()

    connect = _database(spark)
    rows = retype(_scanned(spark, sf_dir).select(*FIELDS, "file_path"))
    size = rows.agg(F.sum(values.row_size(F.col("text"), F.col("comment")))).first()[0]
    options = {"name": "nightly", "file": "file_path", "commit_bytes": max(1, size // 20), "connections": 2}
    try:
        unreliable = partial(connect, factory=Lost)
        write_revisions(rows, "database_batches", unreliable, "revisions", **options)
        raise AssertionError("the first run was to fail")
    except PySparkException:
        write_revisions(rows, "database_batches", connect, "revisions", **options)
    return _with_epoch(read_database(spark, connect, "revisions", (0, 1 << 40)))


def database_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As table_modes, of a table in a database."""
    connect = _database(spark)
    bounds = (0, 1 << 40)
    return _modes(
        spark, sf_dir, lambda rows, **how: write_revisions(rows, "database", connect, "revisions", **how),
        lambda: read_database(spark, connect, "revisions", bounds),
    )


def table_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four loads of one table, and what it holds after each."""
    database = f"palimpsest_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{new_location(spark, 'tables')}'")
    return _modes(
        spark, sf_dir, lambda rows, **how: write_revisions(rows, "table", f"{database}.revisions", **how),
        lambda: spark.table(f"{database}.revisions"),
    )


def dump_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dumps of one table, of which one is replaced and one may not be."""
    database = f"palimpsest_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{new_location(spark, 'tables')}'")
    table = f"{database}.revisions"
    typed = retype(dumps.raw_revisions(dumps.table(spark, sf_dir, "conversations")))
    write_revisions(typed.where("page_ns <> 1"), "dump", table, "20191101")
    write_revisions(typed.withColumn("comment", F.lit("second")), "dump", table, "20191201")
    for rows, replace in ((typed, False), (typed.unionByName(typed), True)):
        try:
            write_revisions(rows, "dump", table, "20191201", replace=replace)
        except (tables.TableExists, quality.DuplicateRevision):
            continue
    write_revisions(typed, "dump", table, "20191101", replace=True)
    return spark.table(table).select("dump_date", "id", "comment", "page_ns")


def provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a table with the dump's date and when they were taken in."""
    database = f"palimpsest_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{new_location(spark, 'tables')}'")
    typed = retype(dumps.raw_revisions(dumps.table(spark, sf_dir, "conversations")))
    begun = spark.sql("SELECT current_timestamp()").first()[0]
    write_revisions(with_provenance(typed, "20191101"), "table", f"{database}.revisions")
    now = F.col("ingested_at").between(F.lit(begun), F.current_timestamp())
    return spark.table(f"{database}.revisions").select("id", "dump_date", now.alias("taken_in_now"))


def _modes(spark: SparkSession, sf_dir: str, load: Callable, held: Callable[[], DataFrame]) -> DataFrame:
    raw = dumps.raw_revisions(dumps.table(spark, sf_dir, "conversations"))
    typed = retype(raw)
    changed = typed.withColumn("comment", F.lit("replaced"))
    repeated = typed.unionByName(changed)
    steps = [
        ("first load", typed, False),
        ("load over it", changed, False),
        ("failing replacement", repeated, True),
        ("replacement", changed, True),
    ]
    states = None
    for number, (step, rows, replace) in enumerate(steps):
        try:
            load(rows, replace=replace)
            outcome = "loaded"
        except tables.TableExists:
            outcome = "exists"
        except quality.DuplicateRevision:
            outcome = "duplicates"
        # The table as it is now; the next step replaces it.
        snapshot = new_location(spark, f"table-state-{number}")
        held().agg(
            F.count("*").alias("revisions"),
            F.count_if(F.col("comment") == "replaced").alias("replaced"),
        ).write.parquet(snapshot)
        state = spark.read.parquet(snapshot).select(
            F.lit(step).alias("step"), F.lit(outcome).alias("outcome"), "revisions", "replaced"
        )
        states = state if states is None else states.unionByName(state)
    return states


# ------------------------------------------------------------------ whole job


def dump_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verify, skip the damaged file, parse, retype; revisions and text size per page."""
    path = dumps.history_path(spark, sf_dir)
    name = dumps.dump_file(F.col("path"))
    hashes = staged_files.digest_staged(spark, path, glob="*.bz2", name=name)
    wrong = F.when(F.col("name") == "1", F.lit("0" * 32)).otherwise(F.col("md5"))
    listed = hashes.select("name", wrong.alias("md5"))
    done = ingest_dump(spark, listed.select("name"), listed, path, glob="*.bz2", name=name)
    return done.revisions.groupBy("page_id").agg(
        F.count("*").alias("revisions"),
        F.sum(values.row_size(F.col("text"), F.col("comment"))).alias("size"),
        F.max(F.unix_seconds("timestamp")).alias("last_epoch"),
    )


def ingest_to_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job to CSV: all files are wanted and good, cells as in the dump."""
    path, ledger = dumps.history_path(spark, sf_dir), new_location(spark, "ledger")
    name = dumps.dump_file(F.col("path"))
    listed = staged_files.digest_staged(spark, path, glob="*.bz2", name=name).select("name", "md5")
    for _ in range(2):  # the second run trusts the ledger of the first
        done = ingest_dump(
            spark, listed.select("name"), listed, path, ledger_path=ledger, glob="*.bz2",
            name=name, require_all=True,
        )
    csv = new_location(spark, "csv")
    write_revisions(done.raw, "csv", csv)
    return read_csv(spark, csv)


QUERIES = {
    "listing_links": listing_links,
    "link_filter": link_filter,
    "url_resolve": url_resolve,
    "dump_urls": dump_urls,
    "basename": basename,
    "manifest_parse": manifest_parse,
    "checksum_verify": checksum_verify,
    "trusted_verify": trusted_verify,
    "ledger_skip": ledger_skip,
    "refetch_rounds": refetch_rounds,
    "refetch_list": refetch_list,
    "xml_scan": xml_scan,
    "contributor_variants": contributor_variants,
    "namespace_scan": namespace_scan,
    "null_rules": null_rules,
    "malformed_quarantine": malformed_quarantine,
    "required_fields": required_fields,
    "truncated_files": truncated_files,
    "split_scan": split_scan,
    "retype": retype_query,
    "row_size": row_size,
    "not_null_check": not_null_check,
    "revisions_per_page": revisions_per_page,
    "revision_counts": revision_counts,
    "size_batches": size_batches,
    "pk_check": pk_check,
    "multi_file_union": multi_file_union,
    "csv_roundtrip": csv_roundtrip,
    "csv_parallel": csv_parallel,
    "jdbc_roundtrip": jdbc_roundtrip,
    "table_modes": table_modes,
    "dump_partitions": dump_partitions,
    "provenance": provenance,
    "database_load": database_load,
    "database_modes": database_modes,
    "database_resume": database_resume,
    "stream_ingest": stream_ingest,
    "live_csv": live_csv,
    "clean_source": clean_source,
    "dump_ingest": dump_ingest,
    "ingest_to_csv": ingest_to_csv,
}
