import os

import pytest

from checks import dumps
from dump_text import export, page, revision, write
from palimpsest import (
    fields_only, live_csv, proven_files, quarantined_rows, read_history, remove_taken, stream_history,
    streamed_history, write_revisions,
)
from palimpsest.sinks.csv_files import read_parallel_csv


def dump(path, *numbers):
    for n in numbers:
        pages = [page(str(n), f"p{n}", revisions=[revision(f"{n}{k}") for k in range(3)])]
        write(path / f"{n}.xml.bz2", export(*pages))


def ids(rows):
    return sorted(int(r.id) for r in rows.collect())


def test_new_files_only(spark, tmp_path):
    source, staging, state = tmp_path / "in", str(tmp_path / "staged"), str(tmp_path / "state")
    fed = []

    def feed(rows, number):
        fed.append(number)
        write_revisions(rows, "parallel_csv", f"{tmp_path}/csv/batch={number}")

    def run():
        stream_history(
            spark, str(source), staging, state, files_per_batch=1, glob="*.bz2", on_batch=feed
        ).awaitTermination()

    dump(source, 1, 2, 3)
    run()
    assert fed == [0, 1, 2]
    assert ids(streamed_history(spark, staging)) == [n * 10 + k for n in (1, 2, 3) for k in range(3)]
    run()
    assert fed == [0, 1, 2]
    dump(source, 4)
    long_ago = os.stat(source / "4.xml.bz2").st_mtime - 30 * 86400
    os.utime(source / "4.xml.bz2", (long_ago, long_ago))
    run()
    assert fed == [0, 1, 2, 3]
    rows = fields_only(streamed_history(spark, staging))
    batch = fields_only(read_history(spark, str(source)))
    assert rows.exceptAll(batch).isEmpty() and batch.exceptAll(rows).isEmpty()
    fed_rows = read_parallel_csv(spark, f"{tmp_path}/csv/*")
    assert fed_rows.exceptAll(batch).isEmpty() and fed_rows.count() == batch.count() == 12


def test_replayed_batch_overwrites(spark, tmp_path):
    source, staging = tmp_path / "in", str(tmp_path / "staged")
    dump(source, 1, 2)
    # A second run with a fresh checkpoint sends the same batch numbers again.
    for state in ("a", "b"):
        stream_history(spark, str(source), staging, str(tmp_path / state)).awaitTermination()
    assert streamed_history(spark, staging).count() == 6


def test_taken_files_are_archived(spark, tmp_path):
    source, archive = tmp_path / "in", tmp_path / "done"
    dump(source, 1, 2, 3)
    stream_history(
        spark, str(source), str(tmp_path / "staged"), str(tmp_path / "state"), files_per_batch=1,
        clean_source="archive", archive=str(archive),
    ).awaitTermination()
    left = [f for f in os.listdir(source) if f.endswith(".bz2")]
    assert len(left) < 3
    assert streamed_history(spark, str(tmp_path / "staged")).count() == 9


def test_stream_equals_batch(spark, tmp_path):
    path = str(tmp_path / "dump")
    conversations = dumps.table(spark, "/root/testdata/sf0.001", "conversations")
    dumps.write_history(conversations, path, 5)
    staging = str(tmp_path / "staged")
    stream_history(
        spark, path, staging, str(tmp_path / "state"), files_per_batch=2, glob="*.bz2"
    ).awaitTermination()
    rows, batch = fields_only(streamed_history(spark, staging)), fields_only(read_history(spark, path))
    assert rows.count() == conversations.count()
    assert rows.exceptAll(batch).isEmpty()


def test_files_go_only_after_proof(spark, tmp_path):
    source, staging, state = tmp_path / "in", str(tmp_path / "staged"), str(tmp_path / "state")
    dump(source, 1, 2)
    bad = export(page("3", revisions=[revision("31"), revision("32").replace("<id>", "<id", 1)]))
    write(source / "3.xml", bad)
    whole = export(page("4", revisions=[revision("41")]))
    write(source / "4.xml", whole[: whole.index("</mediawiki>")])
    write(source / "odd %20name.xml", whole)

    def run(**options):
        stream_history(spark, str(source), staging, state, files_per_batch=2, **options).awaitTermination()

    def left():
        return sorted(p.name for p in source.iterdir() if not p.name.startswith("."))

    assert remove_taken(spark, staging, state) == 0 and proven_files(spark, staging, state).isEmpty()
    run(on_batch=live_csv(str(tmp_path / "csv")))
    rows = read_parallel_csv(spark, str(tmp_path / "csv"))
    sound = streamed_history(spark, staging).where("problem is null")
    assert rows.count() == sound.count() == 9 and quarantined_rows(streamed_history(spark, staging)).count() == 1
    assert remove_taken(spark, staging, state, archive=str(tmp_path / "done")) == 3
    assert left() == ["3.xml", "4.xml"]
    assert sorted(p.name for p in (tmp_path / "done").rglob("*.xml*") if p.suffix != ".crc") == [
        "1.xml.bz2", "2.xml.bz2", "odd %20name.xml"]
    assert remove_taken(spark, staging, state) == 0
    dump(source, 5)
    run()
    assert remove_taken(spark, staging, state) == 1 and left() == ["3.xml", "4.xml"]


def test_a_batch_without_commit_keeps_its_files(spark, tmp_path):
    source, staging, state = tmp_path / "in", str(tmp_path / "staged"), str(tmp_path / "state")
    dump(source, 1, 2, 3)

    def fails(rows, number):
        if number == 1:
            raise OSError("sink is down")

    query = stream_history(spark, str(source), staging, state, files_per_batch=1, on_batch=fails)
    with pytest.raises(Exception, match="sink is down"):
        query.awaitTermination()
    assert streamed_history(spark, staging).count() == 6  # the second was staged
    assert remove_taken(spark, staging, state) == 1
    assert len([p for p in source.iterdir() if p.name.endswith(".bz2") and not p.name.startswith(".")]) == 2
    stream_history(spark, str(source), staging, state, files_per_batch=1).awaitTermination()
    assert streamed_history(spark, staging).count() == 9
    assert remove_taken(spark, staging, state) == 2
