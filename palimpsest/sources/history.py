"""Page histories: MediaWiki export XML, compressed or not, to revision rows.

A page of a real dump can hold a million revisions, so a page is never one
record here. The text source cuts a file at ``</revision>``; each record then
holds one revision and, for the first revision of a page, the page's header in
front of it. Three steps make rows of that:

1. ``split_records`` cuts each record into header and revision (JVM);
2. ``parse_revisions`` parses the revisions (``from_xml``), of which only the fields
   asked for are built;
3. ``carry_headers`` copies the header to the records after it, within one file
   block (Arrow batches, one pass, constant memory). Where only some namespaces are
   wanted it comes first, and revisions of other pages are not parsed;
4. ``stage_history`` writes the rows as Parquet. Revisions of a page that runs on
   into the next block get its header once, from one row per block, and are written
   beside the others: only their texts may be shuffled, and no reader of the staged
   table shuffles any.

Literal tags cannot occur inside a revision's text: exports escape them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palimpsest.functions.values import empty_as_null
from palimpsest.schemas import CORRUPT, FIELDS, PAGE_XML, revision_xml
from palimpsest.workspace import new_location

RECORD_END = "</revision>"
REVISION_START = "<revision"
PAGE_START = r"<page[\s>]"
PAGE_END = "</page>"
ROOT_START = "<mediawiki"
ROOT_END = "</mediawiki>"
XML_OPTIONS = {"ignoreSurroundingSpaces": "false", "columnNameOfCorruptRecord": CORRUPT}

# Why a row is not a revision.
UNREADABLE = "unreadable revision"
NO_PAGE_HEADER = "incomplete page header"
MISSING_ELEMENT = "missing contributor or text"
MISSING_FIELD = "missing id or timestamp"

_SOURCE = ["file_path", "file_name", "block_start"]
_HEADER = ["page_title", "page_ns", "page_id"]
_MARKS = (
    "file_path string, file_name string, block_start long, seq long, starts_page boolean, "
    "page_known boolean, is_revision boolean, readable boolean, complete boolean, root_closed boolean, "
    "malformed_xml string"
)
#: Fields that tell whether a row is a revision; always staged.
_JUDGED = ["id", "timestamp", *_HEADER]
_ELEMENTS = {"text", "contributor_id", "contributor_name", "contributor_ip"}


def _staged_fields(columns: list[str] | None) -> list[str]:
    unknown = set(columns or ()) - set(FIELDS)
    if unknown:
        raise ValueError(f"no such field: {', '.join(sorted(unknown))}")
    return [c for c in FIELDS if columns is None or c in columns or c in _JUDGED]


def _rows_schema(columns: list[str] | None) -> str:
    return ", ".join([_MARKS, *[f"{name} string" for name in _staged_fields(columns)]])


_CUT = "file_path string, block_start long, seq long, cut boolean"
_BLOCKS = "file_path string, block_start long, page_title string, page_ns string, page_id string"


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text records of the files, with the file and the block each one is from."""
    return with_source(spark.read.option("lineSep", RECORD_END).text(path))


def no_records(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [], "value string, file_path string, file_name string, block_start long"
    )


def with_source(text: DataFrame) -> DataFrame:
    return text.select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def split_records(records: DataFrame) -> DataFrame:
    """Header and revision fragments, one row per revision, in file order.

    A record with several revision starts comes from a revision that was never
    closed: each start then gets a row and all but the last are marked open.
    """
    value = F.col("value")
    before, after = F.col("before"), F.col("after")
    mark = len(REVISION_START)
    is_single = (
        F.octet_length(before) + mark + F.octet_length(after) == F.octet_length(value)
    )
    none = F.lit(None).cast("string")

    def fragment(lead, body, closed):
        return F.struct(lead.alias("lead"), body.alias("body"), closed.alias("closed"))

    # Each token is the body of one revision and what leads up to the next.
    tokens = F.split(value, REVISION_START)
    starts_here = F.size(tokens) - 1
    several = F.arrays_zip(
        F.slice(tokens, F.lit(1), starts_here),
        F.slice(tokens, F.lit(2), starts_here),
        F.array_append(F.array_repeat(F.lit(False), starts_here - 1), F.lit(True)),
    )
    fragments = (
        F.when(~value.contains(REVISION_START), F.array(fragment(value, none, F.lit(True))))
        .when(is_single, F.array(fragment(before, after, F.lit(True))))
        .otherwise(several.cast("array<struct<lead: string, body: string, closed: boolean>>"))
    )
    lead = F.col("lead")
    starts_page = lead.contains("<page") & lead.rlike(PAGE_START)
    starts, ends = F.regexp_count(lead, F.lit(PAGE_START)), F.regexp_count(lead, F.lit(PAGE_END))
    previous_closed = (starts <= ends) | ((starts == ends + 1) & lead.contains(ROOT_START))
    page_fragment = F.concat(
        F.lit("<page"), F.regexp_extract(lead, r"(?s)^.*<page(?=[\s>])(.*)$", 1), F.lit(PAGE_END)
    )
    page_xml = F.when(starts_page & previous_closed, page_fragment)
    page = F.from_xml(page_xml, PAGE_XML, XML_OPTIONS)
    return (
        records.select(
            *_SOURCE,
            "value",
            F.substring_index(value, REVISION_START, 1).alias("before"),
            F.substring_index(value, REVISION_START, -1).alias("after"),
        )
        .select(*_SOURCE, F.inline(fragments))
        .select(
            *_SOURCE,
            F.monotonically_increasing_id().alias("seq"),
            starts_page.alias("starts_page"),
            page.alias("page"),
            "body",
            "closed",
            lead.contains(ROOT_END).alias("root_closed"),
        )
        .select(
            *_SOURCE,
            "seq",
            "starts_page",
            F.col("starts_page").alias("page_known"),
            empty_as_null(F.col("page.title")).alias("page_title"),
            empty_as_null(F.col("page.ns")).alias("page_ns"),
            empty_as_null(F.col("page.id")).alias("page_id"),
            "body",
            "closed",
            "root_closed",
        )
    )


def carry_headers(fragments: DataFrame) -> DataFrame:
    """Copy each page header to the rows after it, up to the end of the block.

    Rows before the first header of a block stay ``page_known = false``.
    """
    return fragments.mapInArrow(_header_carrier(), fragments.schema)


def _header_carrier():
    """The function the tasks run; defined here so that Spark ships it by value."""
    header_columns = list(_HEADER)

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_block = None
        held = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            columns = {name: batch.column(name) for name in batch.schema.names}
            codes = columns["file_path"].dictionary_encode().indices.to_numpy()
            starts = columns["block_start"].to_numpy()
            if (columns["file_path"][0].as_py(), starts[0]) != held_block:
                held = None
            rows = np.arange(batch.num_rows)
            new_block = np.r_[False, (codes[1:] != codes[:-1]) | (starts[1:] != starts[:-1])]
            block_row = np.maximum.accumulate(np.where(new_block, rows, 0))
            has_header = columns["starts_page"].to_numpy(zero_copy_only=False)
            header_row = np.maximum.accumulate(np.where(has_header, rows, -1))
            in_batch = header_row >= block_row
            from_held = ~in_batch & (block_row == 0) & (held is not None)
            known = in_batch | from_held
            # Position 0 is the header held from the batch before, row i is position i + 1.
            source = pa.array(np.where(in_batch, header_row + 1, 0), mask=~known)
            for name in header_columns:
                front = pa.array([held[name] if held else None], columns[name].type)
                columns[name] = pa.concat_arrays([front, columns[name]]).take(source)
            columns["page_known"] = pa.array(known)
            held_block = (columns["file_path"][-1].as_py(), starts[-1])
            held = {n: columns[n][-1].as_py() for n in header_columns} if known[-1] else None
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return carry


def parse_revisions(fragments: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Parse the revision fragments; absent and empty values become null.

    Of the 11 fields only ``columns`` and those that every check needs are built.
    ``complete`` is null if what it looks at is not among them.
    """
    fields = _staged_fields(columns)
    whole = _ELEMENTS <= set(fields)
    start, end = F.lit(REVISION_START), F.lit(RECORD_END)
    xml = F.when(F.col("closed"), F.concat(start, F.col("body"), end))
    revision = F.from_xml(xml, revision_xml(fields), XML_OPTIONS)
    r = F.col("r")
    readable = F.col("closed") & r[CORRUPT].isNull()
    is_revision = F.col("body").isNotNull()
    kept_xml = F.when(is_revision & ~readable, F.concat(start, F.col("body")))
    complete = r["contributor"].isNotNull() & r["text"].isNotNull() if whole else F.lit(None).cast("boolean")
    inside = {"contributor_id": ["contributor", "id"], "contributor_name": ["contributor", "username"],
              "contributor_ip": ["contributor", "ip"], "parent_id": ["parentid"]}

    def value(name: str):
        if name in _HEADER:
            return F.col(name)
        found = r
        for step in inside.get(name, [name]):
            found = found[step]
        return empty_as_null(found).alias(name)

    return fragments.withColumn("r", revision).select(
        *_SOURCE,
        "seq",
        "starts_page",
        "page_known",
        is_revision.alias("is_revision"),
        (is_revision & readable).alias("readable"),
        complete.alias("complete"),
        "root_closed",
        kept_xml.alias("malformed_xml"),
        *[value(name) for name in fields],
    )


def stage_history(
    records: DataFrame,
    location: str,
    mode: str = "errorifexists",
    part: str = "",
    columns: list[str] | None = None,
    namespaces: list[str | int] | None = None,
) -> None:
    """Decompress and parse once, into columnar tables below ``location``.

    ``rows`` has a row per record, ``blocks`` the page that is open where a block
    begins, ``repaired`` the revisions before their block's first header, with that
    page, and ``cut`` where files end inside a revision. ``part`` is a partition
    folder (``batch=7``) within each. ``columns`` are the fields to stage, beside
    those that say whether a row is a revision; ``namespaces`` the pages to keep, with
    those whose header is incomplete.
    """
    spark = records.sparkSession

    def write(table: DataFrame, name: str) -> str:
        where = f"{location}/{name}/{part}"
        table.write.mode(mode).option("compression", "zstd").parquet(where)
        return where

    fragments = split_records(records)
    if namespaces is None:
        parsed = carry_headers(parse_revisions(fragments, columns))
    else:
        carried = carry_headers(fragments)
        # the rows of other pages stay, without a revision: they say where pages and files end
        wanted = ~F.col("page_known") | _within(namespaces)
        parsed = parse_revisions(carried.withColumn("body", F.when(wanted, F.col("body"))), columns)
    rows_at = write(parsed, "rows")
    rows = spark.read.schema(_rows_schema(columns)).parquet(rows_at)
    blocks = spark.read.schema(_BLOCKS).parquet(write(open_pages(rows), "blocks"))
    repaired = repaired_rows(rows, blocks)
    write(repaired if namespaces is None else repaired.where(_within(namespaces)), "repaired")
    write(cut_revisions(rows), "cut")


def _within(namespaces: list[str | int]):
    """Pages of these namespaces, and pages that do not say theirs."""
    return F.coalesce(F.col("page_ns").isin([str(n) for n in namespaces]), F.lit(True))


def repaired_rows(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """Revisions before the first header of their block, with the page open there."""
    orphans = rows.where("is_revision and not page_known").drop(*_HEADER)
    return orphans.join(blocks, ["file_path", "block_start"], "left").select(*rows.columns)


def cut_revisions(rows: DataFrame) -> DataFrame:
    """Where a file ends inside a revision: what follows the last one's end is none."""
    last = F.max(F.struct("block_start", "seq", "is_revision")).alias("last")
    by_file = rows.groupBy("file_path").agg(last).where("last.is_revision")
    return by_file.select("file_path", "last.block_start", "last.seq", F.lit(True).alias("cut"))


def open_pages(rows: DataFrame) -> DataFrame:
    """The page that is open where each block begins: at most a row per block.

    Only page starts and rows without a page are looked at, without their texts.
    """
    last_start = F.max_by(F.struct(*_HEADER), F.when(F.col("starts_page"), F.col("seq")))
    turning = rows.where("starts_page or not page_known")
    by_block = turning.groupBy("file_path", "block_start").agg(last_start.alias("last"))
    earlier = (
        Window.partitionBy("file_path")
        .orderBy("block_start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    opened = by_block.withColumn("open", F.last("last", ignorenulls=True).over(earlier))
    return opened.select("file_path", "block_start", "open.*")


def staged_history(
    spark: SparkSession,
    location: str,
    strict_elements: bool = False,
    part: str = "",
    columns: list[str] | None = None,
) -> DataFrame:
    """Revision rows of a staged history, readable or not.

    The 11 fields as text (those of ``columns``, if it was staged with these), where
    each row is from (``file_path``, ``file_name``, ``block_start``, ``seq``), and
    ``problem`` / ``malformed_xml`` for rows that are no revision.
    """
    if strict_elements and not _ELEMENTS <= set(_staged_fields(columns)):
        raise ValueError(f"strict_elements looks at {', '.join(sorted(_ELEMENTS))}")
    schema = _rows_schema(columns)
    rows = spark.read.schema(schema).parquet(f"{location}/rows/{part}")
    known = rows.where("is_revision and page_known")
    repaired = spark.read.schema(schema).parquet(f"{location}/repaired/{part}")
    problem = (
        F.when(~F.col("readable") | F.col("cut").isNotNull(), UNREADABLE)
        .when(
            F.col("page_title").isNull() | F.col("page_ns").isNull() | F.col("page_id").isNull(),
            NO_PAGE_HEADER,
        )
        .when(F.col("id").isNull() | F.col("timestamp").isNull(), MISSING_FIELD)
    )
    if strict_elements:
        problem = problem.when(~F.col("complete"), MISSING_ELEMENT)
    # At most a row for each file that was cut off.
    cut = spark.read.schema(_CUT).parquet(f"{location}/cut/{part}")
    every = known.unionByName(repaired).join(cut, ["file_path", "block_start", "seq"], "left")
    fields = [c for c in FIELDS if columns is None or c in columns]
    return every.select(
        *fields, *_SOURCE, "seq", problem.alias("problem"), "malformed_xml"
    )


def unclosed_files(spark: SparkSession, location: str) -> DataFrame:
    """Staged files that end before their root element does."""
    rows = spark.read.schema(_MARKS).parquet(f"{location}/rows")
    by_file = rows.groupBy("file_path", "file_name").agg(F.max("root_closed").alias("whole"))
    return by_file.where("not whole").select("file_path", "file_name")


def read_history(
    spark: SparkSession,
    path: str | list[str],
    staging: str | None = None,
    strict_elements: bool = False,
    columns: list[str] | None = None,
    namespaces: list[str | int] | None = None,
) -> DataFrame:
    """Stage the files at ``path`` and return their rows (see ``staged_history``).

    With ``columns`` only these fields are built, written and returned; with
    ``namespaces`` only revisions of these pages are parsed.
    """
    location = staging or new_location(spark, "history")
    stage_history(read_records(spark, path), location, columns=columns, namespaces=namespaces)
    return staged_history(spark, location, strict_elements, columns=columns)
