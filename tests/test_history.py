import pytest
from pyspark.sql import functions as F

from checks import dumps
from dump_text import export, page, revision, write
from palimpsest import (
    FIELDS, fields_only, quarantined_rows, read_history, revisions_or_fail, sound_rows,
    stage_history, staged_history, unclosed_files,
)
from palimpsest.sources import history
from palimpsest.workspace import new_location

CONVERSATIONS = "/root/testdata/sf0.001"


def rows_of(spark, path, **options):
    rows = read_history(spark, path, **options).orderBy("file_path", "block_start", "seq").collect()
    return [r.asDict() for r in rows]


def by_id(rows):
    return {r["id"]: r for r in rows}


def test_pages_and_revisions(spark, tmp_path):
    named = "<username>Ada &amp; Co</username><id>900</id>"
    path = write(
        tmp_path / "a.xml.bz2",
        export(
            page("70", "Rivers", "0", [revision("7001", who=named, text="The Elbe\nand others")]),
            page("71", "Talk:Rivers", "1", [
                revision("7102", who="<ip>2001:db8::7</ip>", comment="<comment>/* Elbe */</comment>"),
                revision("7103", "7102", who=named, text="See [[Rivers]]"),
                revision("7104", "7103", who="<ip>2001:db8::8</ip>", text=""),
            ]),
            page("72", "Streams", "0", [revision("7205", who=named, text="#REDIRECT")],
                 more='    <redirect title="Rivers" />\n'),
        ),
    )
    rows = read_history(spark, path)
    assert rows.columns[: len(FIELDS)] == FIELDS
    got = fields_only(revisions_or_fail(rows)).orderBy("id").collect()
    assert [(r.id, r.parent_id, r.page_id, r.page_ns, r.page_title) for r in got] == [
        ("7001", None, "70", "0", "Rivers"),
        ("7102", None, "71", "1", "Talk:Rivers"),
        ("7103", "7102", "71", "1", "Talk:Rivers"),
        ("7104", "7103", "71", "1", "Talk:Rivers"),
        ("7205", None, "72", "0", "Streams"),
    ]
    assert [(r.contributor_id, r.contributor_name, r.contributor_ip) for r in got[:3]] == [
        ("900", "Ada & Co", None), (None, None, "2001:db8::7"), ("900", "Ada & Co", None),
    ]
    assert got[0].text == "The Elbe\nand others" and got[3].text is None
    assert got[1].comment == "/* Elbe */" and got[2].comment is None
    assert {r.timestamp for r in got} == {"2020-01-02T03:04:05Z"}


def test_revision_that_the_file_ends_in(spark, tmp_path):
    whole = export(page("1", "P", "0", [revision("10", text="a"), revision("11", text="b")]))
    cut = whole[: whole.rindex("<text")] + "\n"
    rows = rows_of(spark, write(tmp_path / "a.xml.bz2", cut))
    assert [(r["id"], r["problem"]) for r in rows] == [("10", None), ("11", history.UNREADABLE)]


TEXTS = [
    ("<text></text>", None),
    ("<text />", None),
    ('<text bytes="4" deleted="deleted" />', None),
    ("<text> \n\t </text>", " \n\t "),
    ('<text bytes="9" xml:space="preserve">  a b\n\n</text>', "  a b\n\n"),
    ("<text>a\r\nb\rc</text>", "a\nb\nc"),
    ("<text>&lt;revision&gt; &amp;amp; &quot;q&quot; &#039;s&#10;&#x263a;</text>",
     "<revision> &amp; \"q\" 's\n☺"),
    ("<text>null</text>", "null"),
    ("<text>x<!-- note -->y</text>", "xy"),
    ("<text>été \U0001f30d</text>", "été \U0001f30d"),
]


@pytest.mark.parametrize("name", ["a.xml", "a.xml.bz2"])
def test_text_values(spark, tmp_path, name):
    revisions = [revision(str(i), text_element=element) for i, (element, _) in enumerate(TEXTS)]
    rows = rows_of(spark, write(tmp_path / name, export(page(revisions=revisions))))
    assert [r["problem"] for r in rows] == [None] * len(TEXTS)
    assert [r["text"] for r in rows] == [expected for _, expected in TEXTS]


CONTRIBUTORS = [
    ("<contributor><ip>::1</ip></contributor>", ("::1", None, None)),
    ("<contributor><username>A</username><id>3</id></contributor>", (None, "A", "3")),
    ("<contributor><username>A</username><id></id></contributor>", (None, "A", None)),
    ("<contributor />", (None, None, None)),
    ('<contributor deleted="deleted" />', (None, None, None)),
]


def test_contributors(spark, tmp_path):
    revisions = [
        revision(who=None).replace("<text", who + "\n<text", 1) for who, _ in CONTRIBUTORS
    ]
    rows = rows_of(spark, write(tmp_path / "a.xml", export(page(revisions=revisions))))
    assert [r["problem"] for r in rows] == [None] * len(CONTRIBUTORS)
    found = [(r["contributor_ip"], r["contributor_name"], r["contributor_id"]) for r in rows]
    assert found == [expected for _, expected in CONTRIBUTORS]


def test_other_export_version_and_page_without_revisions(spark, tmp_path):
    text = export(
        page("1", "No history"), page("2", "Has one", revisions=[revision("5")]),
        page("3", "None at the end"), version="0.11",
    )
    rows = rows_of(spark, write(tmp_path / "a.xml", text))
    assert [(r["id"], r["page_id"], r["page_title"]) for r in rows] == [("5", "2", "Has one")]


def test_broken_revision_is_set_aside_alone(spark, tmp_path):
    text = export(
        page("1", revisions=[revision("11"), revision("12").replace("</timestamp>", "", 1),
                             revision("13")]),
        page("2", revisions=[revision("21")]),
    )
    rows = read_history(spark, write(tmp_path / "a.xml", text))
    assert sorted(r.id for r in sound_rows(rows).collect()) == ["11", "13", "21"]
    (bad,) = quarantined_rows(rows).collect()
    assert (bad.problem, bad.page_id) == (history.UNREADABLE, "1")
    assert "<id>12</id>" in bad.malformed_xml
    with pytest.raises(Exception, match="malformed input: unreadable revision"):
        revisions_or_fail(rows).count()


def test_revision_never_closed(spark, tmp_path):
    open_end = revision("12").replace("    </revision>\n", "")
    text = export(
        page("1", "One", revisions=[revision("11"), open_end]),
        page("2", "Two", revisions=[revision("21"), revision("22")]),
    )
    rows = rows_of(spark, write(tmp_path / "a.xml", text))
    assert [(r["id"], r["page_title"], r["problem"]) for r in rows] == [
        ("11", "One", None), (None, "One", history.UNREADABLE), ("21", "Two", None),
        ("22", "Two", None),
    ]


@pytest.mark.parametrize("missing", ["title", "ns", "id"])
def test_incomplete_page_header(spark, tmp_path, missing):
    text = export(
        page("1", revisions=[revision("11")]),
        page(**{"id": "2", missing: None}, revisions=[revision("21"), revision("22")]),
        page("3", revisions=[revision("31")]),
    )
    rows = rows_of(spark, write(tmp_path / "a.xml", text))
    problems = {r["id"]: r["problem"] for r in rows}
    assert problems == {
        "11": None, "21": history.NO_PAGE_HEADER, "22": history.NO_PAGE_HEADER, "31": None
    }


def test_page_never_closed(spark, tmp_path):
    text = export(
        page("1", revisions=[revision("11")]).replace("  </page>\n", ""),
        page("2", revisions=[revision("21")]),
        page("3", revisions=[revision("31")]),
    )
    problems = {r["id"]: r["problem"] for r in rows_of(spark, write(tmp_path / "a.xml", text))}
    assert problems == {"11": None, "21": history.NO_PAGE_HEADER, "31": None}


def test_page_id_after_the_revisions_is_not_guessed(spark, tmp_path):
    late = page("9", revisions=[revision("91")]).replace("    <id>9</id>\n", "")
    late = late.replace("  </page>", "    <id>9</id>\n  </page>")
    rows = rows_of(spark, write(tmp_path / "a.xml", export(late, page("2", revisions=[revision("21")]))))
    assert [(r["id"], r["page_id"], r["problem"]) for r in rows] == [
        ("91", None, history.NO_PAGE_HEADER), ("21", "2", None)
    ]


def test_missing_elements(spark, tmp_path):
    bare = revision("2", who=None)
    untexted = revision("3").replace('<text bytes="1" xml:space="preserve">words</text>', "")
    text = export(page(revisions=[revision("1"), bare, untexted, revision(None, time=None)]))
    path = write(tmp_path / "a.xml", text)
    lenient = rows_of(spark, path)
    assert [r["problem"] for r in lenient] == [None, None, None, history.MISSING_FIELD]
    assert (lenient[3]["id"], lenient[3]["timestamp"]) == (None, None)
    strict = rows_of(spark, path, strict_elements=True)
    assert [r["problem"] for r in strict] == [
        None, history.MISSING_ELEMENT, history.MISSING_ELEMENT, history.MISSING_FIELD
    ]


def test_truncated_file_is_reported(spark, tmp_path):
    whole = export(page("1", revisions=[revision("11"), revision("12")]))
    write(tmp_path / "whole.xml", whole)
    write(tmp_path / "cut.xml", whole[: whole.index("</revision>") + len("</revision>")])
    location = new_location(spark, "cut")
    stage_history(history.read_records(spark, str(tmp_path)), location)
    assert [r.file_name for r in unclosed_files(spark, location).collect()] == ["cut.xml"]
    assert staged_history(spark, location).count() == 3


def long_dump(spark, path, codec, turns):
    conversations = spark.range(turns * 3).select(
        (F.when(F.col("id") < 2 * turns, 0).otherwise(F.col("id") % 50)).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 5 == 0, "system").otherwise("user").alias("role"),
        F.concat(F.sha2(F.col("id").cast("string"), 512), F.lit(" & <more> "), F.hex("id")).alias("text"),
    )
    # One page element for each page: two thirds of all rows are one long page.
    dumps.write_history(conversations, path, 2, codec=codec, turns_per_page_element=10**9)
    return dumps.raw_revisions(conversations)


@pytest.mark.parametrize("codec, split", [("none", 20_000), ("none", 150_000), ("bzip2", 60_000)])
def test_rows_do_not_depend_on_splits_or_batches(spark, tmp_path, setting, codec, split):
    path = str(tmp_path / "dump")
    expected = long_dump(spark, path, codec, 1_000 if codec == "none" else 6_000)
    setting("spark.sql.files.maxPartitionBytes", split)
    setting("spark.sql.files.openCostInBytes", 1)
    setting("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    location = new_location(spark, "split")
    records = history.read_records(spark, path)
    assert records.select("file_path", "block_start").distinct().count() > 4
    stage_history(records, location)
    staged = spark.read.parquet(f"{location}/rows")
    assert staged.where("is_revision and not page_known").count() > 0
    rows = fields_only(revisions_or_fail(staged_history(spark, location)))
    # headers were put right while staging: no reader shuffles texts
    assert "hashpartitioning" not in rows._jdf.queryExecution().toString()
    assert rows.count() == expected.count()
    assert rows.exceptAll(expected).isEmpty()


@pytest.mark.parametrize("chosen", [
    {"columns": ["id", "page_id"]},
    {"columns": []},
    {"namespaces": [1, "2"]},
    {"namespaces": [0], "columns": ["comment", "page_ns"]},
    {"namespaces": [77]},
])
def test_only_what_is_asked_for_is_staged(spark, tmp_path, setting, chosen):
    path = str(tmp_path / "dump")
    long_dump(spark, path, "none", 500)
    setting("spark.sql.files.maxPartitionBytes", 20_000)
    setting("spark.sql.files.openCostInBytes", 1)
    whole = revisions_or_fail(read_history(spark, path))
    location = new_location(spark, "chosen")
    rows = revisions_or_fail(read_history(spark, path, staging=location, **chosen))
    fields = chosen.get("columns", FIELDS)
    if "namespaces" in chosen:
        whole = whole.where(F.col("page_ns").isin([str(n) for n in chosen["namespaces"]]))
    keys = ["file_path", *fields]
    assert [c for c in rows.columns if c in FIELDS] == [c for c in FIELDS if c in fields]
    assert rows.select(keys).exceptAll(whole.select(keys)).isEmpty()
    assert rows.count() == whole.count()
    for part in ("rows", "repaired"):
        staged = spark.read.parquet(f"{location}/{part}")
        assert ("text" in staged.columns) == ("text" in fields)
        if "namespaces" in chosen and "text" in fields:
            known = staged.where("page_known or page_ns is not null")
            assert known.where(~F.col("page_ns").isin([str(n) for n in chosen["namespaces"]])).where("text is not null").isEmpty()


def test_pruned_scans_still_judge_every_revision(spark, tmp_path):
    broken = revision("12").replace("<timestamp>", "<timestamp", 1)
    text = export(page("1", ns="0", revisions=[revision("11"), broken]), page("2", ns="1", revisions=[broken]))
    path = write(tmp_path / "a.xml", text)
    for chosen, problems in (({"columns": ["id"]}, 2), ({"namespaces": [0]}, 1), ({"namespaces": [1], "columns": []}, 1)):
        assert quarantined_rows(read_history(spark, path, **chosen)).count() == problems
    with pytest.raises(ValueError):
        read_history(spark, path, columns=["id"], strict_elements=True)
    with pytest.raises(ValueError):
        read_history(spark, path, columns=["nothing"])


def test_cut_files_with_namespaces(spark, tmp_path):
    whole = export(page("1", ns="0", revisions=[revision("11")]), page("2", ns="1", revisions=[revision("21"), revision("22")]))
    path = write(tmp_path / "a.xml", whole[: whole.rindex("</text>")])
    problems = [(n, quarantined_rows(read_history(spark, path, namespaces=[n])).count()) for n in (0, 1)]
    assert problems == [(0, 0), (1, 1)]


def test_same_rows_as_the_xml_data_source(spark, tmp_path):
    path = str(tmp_path / "dump")
    conversations = dumps.table(spark, CONVERSATIONS, "conversations")
    dumps.write_history(conversations, path, 3, codec="none")
    schema = (
        "title string, ns string, id string, revision array<struct<id: string, "
        "contributor: struct<username: string>, text: string>>"
    )
    reader = spark.read.format("xml").option("rowTag", "page").schema(schema)
    pages = reader.option("ignoreSurroundingSpaces", "false").load(path)
    theirs = pages.select("title", "ns", F.col("id").alias("page"), F.inline("revision")).select(
        "title", "ns", "page", "id", F.col("contributor.username").alias("name"),
        F.nullif("text", F.lit("")).alias("text"),
    )
    ours = read_history(spark, path).select(
        F.col("page_title").alias("title"), F.col("page_ns").alias("ns"),
        F.col("page_id").alias("page"), "id", F.col("contributor_name").alias("name"), "text",
    )
    assert ours.count() == conversations.count()
    assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()


def test_no_rows_at_all(spark, tmp_path):
    path = write(tmp_path / "a.xml", export(page("1", "No history")))
    assert rows_of(spark, path) == []
