import hashlib

import pytest
from pyspark.sql import functions as F

from palimpsest.sources.staged_files import known_scheme, open_path
from palimpsest import (
    append_to_ledger, clear_ledger, digest_staged, history_links, list_staged, listing_links,
    read_ledger, read_listing, read_manifest, refetch_list, verify, verify_unless_trusted,
    wanted_files,
)
from palimpsest.functions import links


def values(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_listing_to_wanted_files(spark, tmp_path):
    page = tmp_path / "listing.html"
    page.write_text(
        '<a href="/enwiki/20200101/a-pages-meta-history1.xml.bz2">1</a>\n'
        '<a href="/enwiki/20200101/a-pages-meta-history1.xml.bz2">again</a>'
        '<a href="/enwiki/20200101/a-pages-meta-history2.xml.7z">7z</a>'
        '<a href="">empty</a><a href="/enwiki/20200101/a-pages-articles.xml.bz2">no</a>\n'
        '<a href="/enwiki/20200101/b-pages-meta-history2.xml.bz2">2</a>'
    )
    found = listing_links(read_listing(spark, str(page)))
    assert found.count() == 5
    assert values(wanted_files(found, "20200101")) == [
        (f"https://dumps.wikimedia.org/enwiki/20200101/{n}", n)
        for n in ("a-pages-meta-history1.xml.bz2", "b-pages-meta-history2.xml.bz2")
    ]


def test_href_may_hold_any_separator_but_a_newline(spark):
    text = 'href="a b" href="c\rd" href="e\nf"'
    found = spark.createDataFrame([(text,)], "html string").select(
        F.explode(links.hrefs(F.col("html")))
    )
    assert [r[0] for r in found.collect()] == ["a b", "c\rd"]


def test_links_of_the_wrong_kind_fail(spark):
    urls = spark.createDataFrame([("/rooted",), ("bare",)], "url string")
    for date in ("latest", "20200101"):
        with pytest.raises(Exception, match="unexpected link"):
            urls.select(links.full_url(F.col("url"), date)).collect()
    null = urls.select(links.full_url(F.col("url"), "latest", on_unexpected="null"))
    assert [r[0] for r in null.collect()] == [None, "https://dumps.wikimedia.org/enwiki/latest/bare"]


def test_history_links_are_distinct(spark):
    urls = spark.createDataFrame([("x-pages-meta-history.bz2",)] * 3, "url string")
    assert history_links(urls).count() == 1


def test_manifest_lines(spark, tmp_path):
    path = tmp_path / "sums.txt"
    path.write_text("abc  one.bz2 \ndef  two.bz2\t\n")
    assert values(read_manifest(spark, str(path))) == [("abc", "one.bz2"), ("def", "two.bz2")]
    path.write_text("abc one.bz2\n")
    with pytest.raises(Exception, match="not a manifest line"):
        read_manifest(spark, str(path)).collect()


@pytest.fixture
def staged(tmp_path):
    folder = tmp_path / "staged files"
    (folder / "deeper").mkdir(parents=True)
    files = {"a.bz2": b"alpha" * 1000, "b c.bz2": b"beta", "new.bz2": b"n", "d.bz2": b"\x00\xff" * 5000}
    for name, content in files.items():
        (folder / ("deeper" if name == "d.bz2" else ".") / name).write_bytes(content)
    # The file source passes over empty files: they count as not staged.
    (folder / "empty.bz2").write_bytes(b"")
    (folder / "other.txt").write_text("not one of them")
    return str(folder), {n: hashlib.md5(c).hexdigest() for n, c in files.items()}


@pytest.mark.parametrize("opener", [None, lambda path: open_path(path)])
def test_digests(spark, staged, opener):
    path, expected = staged
    found = digest_staged(spark, path, glob="*.bz2", opener=opener)
    assert {r["name"]: r["md5"] for r in found.collect()} == expected
    assert found.count() == len(expected)


def test_status_and_refetch(spark, staged):
    path, md5 = staged
    manifest = spark.createDataFrame(
        [("a.bz2", md5["a.bz2"]), ("a.bz2", md5["a.bz2"]), ("b c.bz2", "0" * 32),
         ("d.bz2", md5["d.bz2"]), ("d.bz2", "1" * 32), ("missing.bz2", "2" * 32)],
        "name string, md5 string",
    )
    checked = verify(digest_staged(spark, path, glob="*.bz2"), manifest)
    status = {r["name"]: r["status"] for r in checked.collect()}
    assert status == {
        "a.bz2": "verified", "b c.bz2": "mismatch", "d.bz2": "conflict", "new.bz2": "unlisted"
    }
    wanted = spark.createDataFrame([(n,) for n in [*status, "missing.bz2", "a.bz2"]], "name string")
    assert values(refetch_list(wanted, checked)) == [
        (n,) for n in ("b c.bz2", "d.bz2", "missing.bz2", "new.bz2")
    ]


def test_ledger_saves_reading(spark, staged, tmp_path):
    path, md5 = staged
    ledger_path = str(tmp_path / "ledger")
    for _ in range(2):
        append_to_ledger(spark.createDataFrame([("a.bz2",), ("gone.bz2",)], "name string"), ledger_path)
    ledger = read_ledger(spark, ledger_path)
    assert values(ledger) == [("a.bz2",), ("gone.bz2",)]
    manifest = spark.createDataFrame(list(md5.items()), "name string, md5 string").where("name <> 'd.bz2'")
    listing = list_staged(spark, path, glob="*.bz2")
    # A trusted file is not opened: its listed path need not even be there.
    listing = listing.withColumn(
        "path", F.when(F.col("name") == "a.bz2", "file:/nowhere/a.bz2").otherwise(F.col("path"))
    )
    checked = verify_unless_trusted(listing, manifest, ledger)
    assert {r["name"]: r["status"] for r in checked.collect()} == {
        "a.bz2": "trusted", "b c.bz2": "verified", "new.bz2": "verified", "d.bz2": "unlisted"
    }
    clear_ledger(spark, ledger_path)
    assert read_ledger(spark, ledger_path).isEmpty()


def test_schemes():
    assert known_scheme("s3a") == known_scheme("s3n") == "s3"
    assert open_path("file:/a/b c")[1] == open_path("/a/b c")[1] == "/a/b c"
    with pytest.raises(ValueError, match="dbfs"):
        known_scheme("dbfs")


def test_ledger_that_is_not_there_is_empty(spark, tmp_path):
    assert read_ledger(spark, str(tmp_path / "none")).count() == 0
