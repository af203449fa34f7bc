"""The given tables written out as what a dump consists of.

The tables hold no dump, so ``conversations`` becomes page histories (a page
per conversation, a revision per turn) and ``documents`` becomes staged files.
Rules on the keys put in every case the readers must tell apart. Whole tables
are written; the number of files follows from their size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.workspace import new_location

FILE_BYTES = 16 * 1024 * 1024
TURNS_PER_PAGE_ELEMENT = 1000

# Names of written dumps, by session, table folder and kind.
_written: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_count(texts: DataFrame, least: int) -> int:
    """Files needed for a table's texts at ``FILE_BYTES`` each."""
    size = F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))
    needed = F.ceil(size / F.lit(float(FILE_BYTES)))
    return int(texts.select(F.greatest(F.lit(least), needed)).first()[0])


def once(spark: SparkSession, sf_dir: str, kind: str, write) -> str:
    """Path of a dump written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _written:
        path = new_location(spark, kind)
        write(path)
        _written[key] = path
    return _written[key]


# ---------------------------------------------------------------- revisions

REVISIONS = {
    "id": "conv_id * 1000000 + turn + 1",
    "parent_id": "CASE WHEN turn > 0 THEN conv_id * 1000000 + turn END",
    "page_title": """concat('c', conv_id, ' & <"co">')""",
    "contributor_id": """CASE WHEN role = 'system' OR (conv_id + turn) % 11 < 3 THEN NULL
                              ELSE 1 + conv_id % 97 END""",
    "contributor_name": "CASE WHEN role <> 'system' AND (conv_id + turn) % 11 >= 2 THEN role END",
    "contributor_ip": "CASE WHEN role = 'system' THEN concat('192.0.2.', turn % 256) END",
    "timestamp": """concat('2019-11-05T', lpad(cast((turn div 60) % 24 as string), 2, '0'), ':',
                           lpad(cast(turn % 60 as string), 2, '0'), ':00Z')""",
    "text": r"""CASE (conv_id + turn) % 9 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN ' \n\t '
                     WHEN 3 THEN concat('  ', text, '\n\n')
                     WHEN 4 THEN concat(text, ' <ref name="a">&amp; it''s</ref>, "",\\"')
                     ELSE text END""",
    "comment": """CASE (conv_id + 2 * turn) % 5 WHEN 3 THEN 'say "<b>", it''s' WHEN 4
                       THEN concat('turn ', turn) END""",
    "page_id": "conv_id",
    "page_ns": "conv_id % 3",
}


def raw_revisions(conversations: DataFrame) -> DataFrame:
    """The raw rows a scan of the written dump must give, computed directly."""
    return conversations.selectExpr(
        *[f"cast({expression} as string) AS {name}" for name, expression in REVISIONS.items()]
    )


def _escaped(value: str) -> str:
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        value = f"replace({value}, '{mark}', '{entity}')"
    return value


def _revision_xml(damaged: bool, lacking: bool = False) -> Column:
    who = "(conv_id + turn) % 11"
    tag = "(conv_id + turn) % 9"
    note = "(conv_id + 2 * turn) % 5"
    broken = "conv_id % 7 = 1 AND turn = 1" if damaged else "false"
    open_end = "conv_id % 7 = 2 AND turn = 1" if damaged else "false"
    no_id = "conv_id % 5 = 3 AND turn % 3 = 1" if lacking else "false"
    no_time = "conv_id % 4 = 3 AND turn % 3 = 2" if lacking else "false"
    return F.expr(
        f"""concat_ws('\n',
        '    <revision>',
        CASE WHEN NOT ({no_id}) THEN concat('      <id>', {REVISIONS["id"]}, '</id>') END,
        concat('      <parentid>', {REVISIONS["parent_id"]}, '</parentid>'),
        CASE WHEN NOT ({no_time})
             THEN concat('      <timestamp>', {REVISIONS["timestamp"]}, '</timestamp>') END,
        CASE WHEN role = 'system'
               THEN concat('      <contributor><ip>', {REVISIONS["contributor_ip"]},
                           '</ip></contributor>')
             WHEN {who} = 0 THEN '      <contributor />'
             WHEN {who} = 1 THEN '      <contributor deleted="deleted" />'
             WHEN {who} = 2 THEN concat('      <contributor><username>', role,
                                        '</username><id></id></contributor>')
             ELSE concat('      <contributor>\n        <username>', role, '</username>\n        <id>',
                         1 + conv_id % 97, '</id>\n      </contributor>') END,
        CASE WHEN {broken} THEN '      <comment>never closed'
             WHEN {note} = 1 THEN '      <comment></comment>'
             WHEN {note} = 2 THEN '      <comment deleted="deleted" />'
             ELSE concat('      <comment>', {_escaped(REVISIONS["comment"])}, '</comment>') END,
        CASE WHEN turn % 2 = 0 THEN '      <model>wikitext</model>' END,
        '      <format>text/x-wiki</format>',
        CASE WHEN {tag} = 0 THEN '      <text bytes="0" xml:space="preserve"></text>'
             WHEN {tag} = 1 THEN '      <text bytes="9" deleted="deleted" />'
             ELSE concat('      <text bytes="', octet_length({REVISIONS["text"]}),
                         '" xml:space="preserve">', {_escaped(REVISIONS["text"])}, '</text>') END,
        CASE WHEN turn % 2 = 1 THEN '      <model>wikitext</model>' END,
        '      <sha1>0000000000000000000000000000000</sha1>',
        CASE WHEN NOT ({open_end}) THEN '    </revision>' END)"""
    )


def _page_xml(damaged: bool) -> Column:
    title = f"concat('    <title>', {_escaped(REVISIONS['page_title'])}, '</title>')"
    ns = "concat('    <ns>', conv_id % 3, '</ns>')"
    if damaged:
        title = f"CASE WHEN conv_id % 7 <> 0 THEN {title} END"
        ns = f"CASE WHEN conv_id % 7 = 3 THEN '    <ns></ns>' ELSE {ns} END"
    return F.expr(
        f"""concat_ws('\n', '  <page>', {title}, {ns}, concat('    <id>', conv_id, '</id>'),
        CASE WHEN conv_id % 4 = 0 THEN '    <redirect title="elsewhere" />' END)"""
    )


ROOT_XML = (
    '<mediawiki xmlns="http://www.mediawiki.org/xml/export-0.10/" version="0.10" xml:lang="en">\n'
    "  <siteinfo>\n    <sitename>Example</sitename>\n    <namespaces>\n"
    '      <namespace key="0" case="first-letter" />\n'
    '      <namespace key="1" case="first-letter">Talk</namespace>\n'
    "    </namespaces>\n  </siteinfo>"
)


def write_history(
    conversations: DataFrame, path: str, files: int, damaged: bool = False, codec: str = "bzip2",
    turns_per_page_element: int = TURNS_PER_PAGE_ELEMENT, lacking: bool = False,
    cut: bool = False,
) -> None:
    """Page histories in ``files`` files, ``<path>/file=<k>/...``.

    As in real dumps, a page with a long history is spread over several page
    elements and files, so no file grows with one page. ``lacking`` leaves out ids
    and timestamps by rule. ``cut`` ends files early: those numbered 1 modulo 4
    between two elements of their last revision, 2 after that revision, 3 inside
    one of its elements.
    """
    spark = conversations.sparkSession
    part = F.expr(f"turn div {turns_per_page_element}")
    turns = conversations.select("*", part.alias("part"))
    keys = ["conv_id", "part"]

    def placed(rows: DataFrame, step: int, turn: Column, value: Column) -> DataFrame:
        file = F.expr(f"(conv_id + part) % {files}")
        return rows.select(
            file.alias("file"), *keys, F.lit(step).alias("step"), turn.alias("turn"),
            value.alias("value"),
        )

    pages = turns.select(*keys).distinct()
    nothing = F.lit(0).cast("long")
    lines = (
        placed(pages, 1, nothing, _page_xml(damaged))
        .unionByName(placed(turns, 2, F.col("turn"), _revision_xml(damaged, lacking)))
        .unionByName(placed(pages, 3, nothing, F.lit("  </page>")))
    )
    for edge, value in ((-1, ROOT_XML), (2**62, "</mediawiki>")):
        lines = lines.unionByName(
            spark.range(files).select(
                F.col("id").alias("file"), F.lit(edge).alias("conv_id"), nothing.alias("part"),
                F.lit(0).alias("step"), nothing.alias("turn"), F.lit(value).alias("value"),
            )
        )
    if cut:
        lines = _cut_off(lines)
    in_order = lines.repartition("file").sortWithinPartitions("file", *keys, "step", "turn")
    in_order.select("file", "value").write.partitionBy("file").option("compression", codec).text(path)


def _cut_off(lines: DataFrame) -> DataFrame:
    """Lines up to the last revision of each file not numbered 0 modulo 4, or into it."""
    place = F.struct("conv_id", "part", "step", "turn")
    ends = lines.where("step = 2").groupBy("file").agg(F.max(place).alias("end"))
    known = lines.join(ends, "file", "left").where(
        (F.col("file") % 4 == 0) | F.col("end").isNull() | (place <= F.col("end"))
    )
    value = F.col("value")
    short = (
        F.when(F.col("file") % 4 == 1, F.substring_index(value, "<text", 1))
        .when(F.col("file") % 4 == 3, F.substring_index(value, "Z</timestamp>", 1))
        .otherwise(value)
    )
    whole = F.coalesce(place != F.col("end"), F.lit(True))
    return known.withColumn("value", F.when(whole, value).otherwise(short))


def history_path(spark: SparkSession, sf_dir: str, kind: str = "dump") -> str:
    """A dump of ``conversations``; kind is "dump", or "damaged", "lacking" or "cut"."""
    cases = {} if kind == "dump" else {kind: True}

    def write(path: str) -> None:
        conversations = table(spark, sf_dir, "conversations")
        write_history(conversations, path, file_count(conversations, 4), **cases)

    return once(spark, sf_dir, kind, write)


def long_pages(conversations: DataFrame) -> DataFrame:
    """The turns as those of five pages, which then run on over many blocks."""
    return conversations.select(
        (F.col("conv_id") % 5).alias("conv_id"),
        F.expr("conv_id div 5 * 1000 + turn").alias("turn"), "role", "text",
    )


def long_history_path(spark: SparkSession, sf_dir: str) -> str:
    """Plain XML with a page element for each of ``long_pages``."""

    def write(path: str) -> None:
        conversations = table(spark, sf_dir, "conversations")
        write_history(
            long_pages(conversations), path, file_count(conversations, 4), codec="none",
            turns_per_page_element=2**62,
        )

    return once(spark, sf_dir, "long-pages", write)


def dump_file(path: Column) -> Column:
    """The number of the file in a path below ``<dump>/file=<k>/``."""
    return F.regexp_extract(path, "/file=([0-9]+)/", 1)


# ------------------------------------------------------------- staged files

def staged_documents(spark: SparkSession, sf_dir: str) -> str:
    """``documents`` as text files ``<path>/name=<name>/...``, a text per line run."""

    def write(path: str) -> None:
        documents = table(spark, sf_dir, "documents")
        files = file_count(documents, 10)
        named = documents.select(
            F.expr(f"concat('pages-meta-history', doc_id % {files}, '.txt')").alias("name"),
            "doc_id", F.col("text").alias("value"),
        )
        in_order = named.repartition("name").sortWithinPartitions("name", "doc_id")
        in_order.select("name", "value").write.partitionBy("name").text(path)

    return once(spark, sf_dir, "staged", write)


def staged_name(path: Column) -> Column:
    return F.regexp_extract(path, "/name=([^/]+)/", 1)
