import bz2
import csv
import glob
import io
import uuid

import pytest
from pyspark.sql import functions as F

from checks import dumps
from palimpsest import FIELDS, RAW_SCHEMA, retype, with_provenance, write_revisions
from palimpsest.operators.quality import DuplicateRevision, MissingValue
from palimpsest.sinks.csv_files import read_csv, read_parallel_csv
from palimpsest.sinks.jdbc import jdbc_options, read_jdbc, register_jdbc_catalog
from palimpsest.sinks import tables
from palimpsest.sinks.tables import TableExists, forgotten_folders, recover_table

SF = "/root/testdata/sf0.001"
AWKWARD = ['a\nb', '"quoted", and, commas', "back\\slash \\\"", " outer spaces ", "lone \r cr", "\r\n",
           "été", "'", '""', "\\", ",", "tab\t", None]


@pytest.fixture(scope="module")
def raw(spark):
    return dumps.raw_revisions(dumps.table(spark, SF, "conversations"))


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [
        (str(i), None, f"t{i}", None, None, None, "2020-01-01T00:00:00Z", text, text, "1", "0")
        for i, text in enumerate(AWKWARD)
    ]
    return spark.createDataFrame(rows, RAW_SCHEMA).repartition(3)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("sink, read", [("csv", read_csv), ("parallel_csv", read_parallel_csv)])
def test_csv_keeps_every_row_and_value(spark, raw, awkward, tmp_path, sink, read):
    rows = raw.unionByName(awkward)
    for _ in range(2):
        assert write_revisions(rows, sink, str(tmp_path / "out")) == rows.count()
        assert same(read(spark, str(tmp_path / "out")), rows)


def test_parts_join_to_one_csv_file(spark, raw, awkward, tmp_path):
    rows = raw.unionByName(awkward)
    write_revisions(rows, "csv", str(tmp_path / "out"))
    parts = [*sorted(glob.glob(f"{tmp_path}/out/header/part-*.csv.bz2")),
             *sorted(glob.glob(f"{tmp_path}/out/rows/part-*.csv.bz2"))]
    assert len(parts) > 2
    joined = b"".join(open(p, "rb").read() for p in parts)
    text = bz2.decompress(joined).decode("utf-8")
    lines = list(csv.reader(io.StringIO(text, newline="")))
    assert lines[0] == FIELDS and lines.count(FIELDS) == 1
    expected = sorted([v or "" for v in r] for r in rows.collect())
    assert sorted(lines[1:]) == expected


def test_parallel_csv_files_have_headers(spark, raw, tmp_path):
    path = str(tmp_path / "out")
    write_revisions(raw, "parallel_csv", path, files=3)
    files = glob.glob(f"{path}/part-*.csv")
    assert len(files) == 3
    assert all(open(f).readline().strip() == ",".join(FIELDS) for f in files)
    with pytest.raises(ValueError):
        write_revisions(raw, "parallel_csv", path, files=0)


def test_unknown_sink(raw):
    with pytest.raises(ValueError):
        write_revisions(raw, "pipe", "x")


def memory_database():
    """Derby in this process's memory: no server, no port."""
    return f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true"


def test_jdbc(spark, raw):
    url, typed = memory_database(), retype(raw)
    assert write_revisions(typed, "jdbc", url, "revisions", connections=2) == raw.count()
    ids = typed.agg(F.min("id"), F.max("id")).first()
    assert same(read_jdbc(spark, url, "revisions"), typed)
    assert same(read_jdbc(spark, url, "revisions", partitions=3, id_range=tuple(ids)), typed)
    with pytest.raises(Exception, match="already exists"):
        write_revisions(typed, "jdbc", url, "revisions")
    failing = [
        (typed.withColumn("page_title", F.lit(None).cast("string")), MissingValue),
        (typed.unionByName(typed), DuplicateRevision),
        (typed.withColumn("id", F.raise_error(F.lit("broken")).cast("long")), Exception),
    ]
    for rows, error in failing:
        with pytest.raises(error):
            write_revisions(rows, "jdbc", url, "revisions", replace=True)
        assert same(read_jdbc(spark, url, "revisions"), typed)
    tables = "(SELECT TABLENAME FROM SYS.SYSTABLES WHERE TABLETYPE = 'T') AS t"
    assert [r[0] for r in read_jdbc(spark, url, tables).collect()] == ["REVISIONS"]
    assert write_revisions(typed.limit(3), "jdbc", url, "revisions", replace=True) == 3
    assert read_jdbc(spark, url, "revisions").count() == 3


def test_jdbc_options():
    url = "jdbc:postgresql://db/x"
    assert jdbc_options(url, multiple_values=True)["url"] == url + "?reWriteBatchedInserts=true"
    assert jdbc_options(url + "?a=b", multiple_values=True)["url"].endswith(
        "?a=b&reWriteBatchedInserts=true")
    assert jdbc_options(url) == {"url": url, "numPartitions": "4", "batchsize": "1000"}
    with pytest.raises(ValueError):
        jdbc_options(url, connections=0)
    with pytest.raises(ValueError):
        jdbc_options(url, rows_per_statement=0)


@pytest.fixture(params=["spark", "database"])
def target(request, spark):
    if request.param == "spark":
        name = f"w{uuid.uuid4().hex[:8]}"
        spark.sql(f"CREATE DATABASE {name}")
        return f"{name}.revisions", {}
    catalog = f"c{uuid.uuid4().hex[:8]}"
    register_jdbc_catalog(spark, catalog, memory_database(), "org.apache.derby.iapi.jdbc.AutoloadedDriver")
    return f"{catalog}.APP.REVISIONS", {"provider": None}


def test_whole_or_nothing(spark, raw, target):
    table, options = target
    namespace = table.rsplit(".", 1)[0]
    typed = retype(raw)

    def tables():
        return spark.sql(f"SHOW TABLES IN {namespace}").count()

    with pytest.raises(DuplicateRevision):
        write_revisions(typed.unionByName(typed), "table", table, **options)
    assert tables() == 0
    assert write_revisions(typed, "table", table, **options) == raw.count()
    with pytest.raises(TableExists):
        write_revisions(typed, "table", table, **options)
    failing = [
        (typed.withColumn("page_title", F.lit(None).cast("string")), MissingValue),
        (typed.unionByName(typed), DuplicateRevision),
        (retype(raw.withColumn("id", F.lit("x"))), Exception),
    ]
    for rows, error in failing:
        with pytest.raises(error):
            write_revisions(rows, "table", table, replace=True, **options)
        assert same(spark.table(table).select(*FIELDS), typed)
        assert tables() == 1
    fewer = typed.where("page_ns = 0")
    assert write_revisions(fewer, "table", table, replace=True, **options) == fewer.count()
    assert same(spark.table(table).select(*FIELDS), fewer)
    assert tables() == 1


def test_provenance(spark, raw, tmp_path):
    name = f"w{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    typed = retype(raw).withColumn("unknown", F.lit(1))
    write_revisions(with_provenance(typed, "20200101"), "table", f"{name}.revisions")
    table = spark.table(f"{name}.revisions")
    assert table.columns == [*FIELDS, "ingested_at", "dump_date"]
    assert table.where("dump_date = '20200101' and ingested_at is not null").count() == raw.count()
    for date, rows in (("20200101", raw), ("20200601", raw.where("page_ns = '0'"))):
        write_revisions(rows, "parallel_csv", str(tmp_path / "csv"), dump_date=date)
    both = read_parallel_csv(spark, str(tmp_path / "csv"))
    assert same(both.where("dump_date = '20200101'").select(*FIELDS), raw)
    assert same(both.where("dump_date = '20200601'").select(*FIELDS), raw.where("page_ns = '0'"))


@pytest.mark.parametrize("dies_at", [1, 2, 3])
def test_a_swap_that_died_is_finished(spark, raw, target, monkeypatch, dies_at):
    table, options = target
    namespace = table.rsplit(".", 1)[0]
    typed = retype(raw)
    write_revisions(typed.where("page_ns = 0"), "table", table, **options)
    count = 0

    class Dead(BaseException):
        pass

    def rename(spark, old, new, plain=tables._rename):
        nonlocal count
        count += 1
        if count == dies_at:
            raise Dead
        plain(spark, old, new)

    with monkeypatch.context() as patch, pytest.raises(Dead):
        patch.setattr(tables, "_rename", rename)
        if dies_at == 3:  # after both renames
            patch.setattr(spark, "sql", lambda text, plain=spark.sql: (_ for _ in ()).throw(Dead())
                          if text.startswith("DROP") else plain(text))
        write_revisions(typed, "table", table, replace=True, **options)
    assert recover_table(spark, table)
    kept = typed.where("page_ns = 0") if dies_at == 1 else typed
    assert same(spark.table(table).select(*FIELDS), kept)
    assert spark.sql(f"SHOW TABLES IN {namespace}").count() == 1
    assert not recover_table(spark, table)
    assert write_revisions(typed, "table", table, replace=True, **options) == raw.count()


def test_dumps_of_one_table(spark, raw):
    name = f"w{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    table, typed = f"{name}.revisions", retype(raw)
    dates = {"20200101": typed, "20200201": typed.where("page_ns = 0")}
    for date, rows in dates.items():
        assert write_revisions(rows, "dump", table, date) == rows.count()
    open_reader = spark.table(table).where("dump_date = '20200101'").select(*FIELDS)
    with pytest.raises(TableExists):
        write_revisions(typed, "dump", table, "20200101")
    with pytest.raises(DuplicateRevision):
        write_revisions(typed.unionByName(typed), "dump", table, "20200101", replace=True)
    with pytest.raises(ValueError):
        write_revisions(typed, "dump", table, "January")
    for date, rows in dates.items():
        assert same(spark.table(table).where(f"dump_date = '{date}'").select(*FIELDS), rows)
    assert len(forgotten_folders(spark, table)) == 1
    assert write_revisions(typed.where("page_ns = 1"), "dump", table, "20200101", replace=True) > 0
    assert same(spark.table(table).where("dump_date = '20200101'").select(*FIELDS), typed.where("page_ns = 1"))
    assert open_reader.count() > 0 and len(forgotten_folders(spark, table)) == 2
