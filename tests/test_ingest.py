import hashlib

import pytest
from pyarrow import fs

from dump_text import export, page, revision, write
from palimpsest import ingest_dump, read_ledger, refetch_until_complete, remove_location
from palimpsest.workspace import new_location


@pytest.fixture
def dump(spark, tmp_path):
    hashes = {}
    for n in (1, 2, 3):
        body = [page(str(n), f"p{n}", revisions=[revision(f"{n}1"), revision(f"{n}2", f"{n}1")])]
        if n == 3:
            body.append(page("30", None, revisions=[revision("301")]))
        path = write(tmp_path / "staged" / f"h{n}.xml.bz2", export(*body))
        hashes[f"h{n}.xml.bz2"] = hashlib.md5(open(path, "rb").read()).hexdigest()
    hashes["h2.xml.bz2"] = "0" * 32
    manifest = spark.createDataFrame(list(hashes.items()), "name string, md5 string")
    wanted = spark.createDataFrame(
        [(n,) for n in ("h1.xml.bz2", "h2.xml.bz2", "h3.xml.bz2", "h4.xml.bz2")], "name string"
    )
    return wanted, manifest, str(tmp_path / "staged"), str(tmp_path / "ledger")


def test_from_files_to_typed_rows(spark, dump):
    wanted, manifest, staged, ledger = dump
    done = ingest_dump(spark, wanted, manifest, staged, ledger_path=ledger, quarantine=True)
    rows = done.revisions.orderBy("id").collect()
    assert [(r.id, r.parent_id, r.page_id, r.page_title) for r in rows] == [
        (11, None, 1, "p1"), (12, 11, 1, "p1"), (31, None, 3, "p3"), (32, 31, 3, "p3")
    ]
    assert [r.id for r in done.quarantined.collect()] == ["301"]
    assert sorted(r.name for r in done.refetch.collect()) == ["h2.xml.bz2", "h4.xml.bz2"]
    assert sorted(r.name for r in read_ledger(spark, ledger).collect()) == ["h1.xml.bz2", "h3.xml.bz2"]

    again = ingest_dump(
        spark, wanted, manifest, staged, ledger=read_ledger(spark, ledger), quarantine=True
    )
    status = {r["name"]: r["status"] for r in again.files.collect()}
    assert status == {
        "h1.xml.bz2": "trusted", "h2.xml.bz2": "mismatch", "h3.xml.bz2": "trusted"
    }
    assert again.revisions.count() == 4


def test_an_opener_fields_namespaces_and_groups_in_the_whole_job(spark, dump, tmp_path):
    wanted, manifest, staged, ledger = dump
    seen = tmp_path / "opened"

    def opener(path):
        with open(seen, "a") as log:
            log.write(path.rsplit("/", 1)[1] + "\n")
        return fs.LocalFileSystem(), path.removeprefix("file:")

    done = ingest_dump(
        spark, wanted, manifest, staged, ledger_path=ledger, quarantine=True, opener=opener,
        columns=["id", "page_id", "page_title"], files_together=1,
    )
    assert sorted(seen.read_text().split()) == ["h1.xml.bz2", "h2.xml.bz2", "h3.xml.bz2"]
    rows = done.revisions.orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(11, "p1", 1), (12, "p1", 1), (31, "p3", 3), (32, "p3", 3)]
    assert [r.id for r in done.quarantined.collect()] == ["301"]
    # the ledger is trusted: only the file that is not in it is opened again
    again = ingest_dump(spark, wanted, manifest, staged, ledger_path=ledger, opener=opener, namespaces=[5])
    assert sorted(seen.read_text().split())[-2:] == ["h2.xml.bz2", "h3.xml.bz2"] and len(seen.read_text().split()) == 4


def test_refetch_ends_with_what_came(spark, dump, tmp_path):
    wanted, manifest, staged, ledger = dump
    calls = []

    def fetch(missing, number):
        calls.append(sorted(r.name for r in missing.collect()))

    done = refetch_until_complete(spark, wanted, manifest, staged, ledger, fetch, most_rounds=3)
    assert calls == [["h2.xml.bz2", "h4.xml.bz2"]] * 2 and not done.complete
    assert sorted(r.name for r in read_ledger(spark, ledger).collect()) == ["h1.xml.bz2", "h3.xml.bz2"]
    rounds = sorted((r["round"], r.name, r.status) for r in done.rounds.collect())
    assert rounds[2:] == [(1, "h3.xml.bz2", "verified"), (2, "h2.xml.bz2", "mismatch"), (3, "h2.xml.bz2", "mismatch")]
    later = refetch_until_complete(spark, wanted.where("name like 'h1%'"), manifest, staged, ledger, fetch)
    assert later.complete and len(calls) == 2 and later.rounds.count() == 0


def test_malformed_input_fails_by_default(spark, dump):
    wanted, manifest, staged, _ = dump
    done = ingest_dump(spark, wanted, manifest, staged)
    with pytest.raises(Exception, match="incomplete page header"):
        done.revisions.count()


def test_nothing_good(spark, dump):
    wanted, manifest, staged, _ = dump
    empty = manifest.where("false")
    done = ingest_dump(spark, wanted, empty, staged)
    assert done.revisions.count() == 0 and done.refetch.count() == wanted.count()
    with pytest.raises(ValueError, match="not staged or not good"):
        ingest_dump(spark, wanted, empty, staged, require_all=True)


def test_staging_is_removed_and_nothing_else(spark, tmp_path):
    path = new_location(spark, "removal")
    spark.range(3).write.parquet(path)
    assert remove_location(spark, path) and not remove_location(spark, path)
    shared = path.rsplit("/", 1)[0]
    for other in (str(tmp_path), shared, f"{shared}/", f"{shared}/..", f"{shared}/a/../../b"):
        with pytest.raises(ValueError):
            remove_location(spark, other)
