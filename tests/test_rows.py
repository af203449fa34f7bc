from palimpsest.functions.values import to_instant
from pyspark.sql import functions as F
import pytest
from pyspark.sql import functions as F

from palimpsest import (
    FIELDS, RAW_SCHEMA, TYPED_SCHEMA, duplicate_ids, null_violations, required_or_fail, retype,
    retype_leniently, revision_counts,
)
from palimpsest.functions.values import row_size

GOOD = {
    "id": "5", "parent_id": None, "page_title": "T", "contributor_id": "", "contributor_name": None,
    "contributor_ip": "::1", "timestamp": "2019-11-05T07:41:09Z", "text": None, "comment": "c",
    "page_id": "9", "page_ns": "-1",
}


def raw(spark, *changes):
    rows = [tuple({**GOOD, **c}[f] for f in FIELDS) for c in changes]
    return spark.createDataFrame(rows, RAW_SCHEMA)


def test_retype(spark):
    typed = retype(raw(spark, {}, {"id": " 7 ", "timestamp": "2019-11-05T09:41:09+02:00"}))
    assert [f.dataType for f in typed.schema] == [f.dataType for f in TYPED_SCHEMA]
    rows = typed.withColumn("seconds", F.unix_seconds("timestamp")).collect()
    assert [(r.id, r.parent_id, r.contributor_id, r.page_ns, r.seconds) for r in rows] == [
        (5, None, None, -1, 1572939669), (7, None, None, -1, 1572939669)
    ]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "bad", [{"id": "1.5"}, {"id": "x"}, {"parent_id": ""}, {"contributor_id": "7a"},
            {"timestamp": "November 5 2019"}, {"page_ns": "99999999999"}],
)
def test_bad_value_fails_or_is_rejected(spark, setting, ansi, bad):
    setting("spark.sql.ansi.enabled", ansi)
    rows = raw(spark, {}, bad)
    (name,) = bad
    with pytest.raises(Exception, match=f"bad {name}: "):
        retype(rows).collect()
    good, rejected = retype_leniently(rows).collect()
    assert good.rejected == []
    assert rejected.rejected == [name] and rejected[name] is None


def test_row_size_counts_bytes(spark):
    rows = spark.createDataFrame([("é", "ab"), (None, None), ("", "\U0001f30d")], "text string, comment string")
    sizes = rows.select(row_size(F.col("text"), F.col("comment"))).collect()
    assert [r[0] for r in sizes] == [304, 300, 304]


def test_required_fields(spark):
    rows = raw(spark, {}, {"id": None}, {"page_title": None, "id": None})
    found = {r["field"]: r["violations"] for r in null_violations(rows).collect()}
    assert found == {"id": 2, "timestamp": 0, "page_id": 0, "page_title": 1, "page_ns": 0}
    with pytest.raises(Exception, match="is null"):
        required_or_fail(rows).collect()
    assert required_or_fail(raw(spark, {})).count() == 1


def test_duplicate_ids(spark):
    rows = spark.range(100).selectExpr("CASE WHEN id < 40 THEN 1 ELSE id END AS id")
    assert [tuple(r) for r in duplicate_ids(rows).collect()] == [(1, 40)]


def test_counts_have_a_total(spark):
    rows = spark.range(10).selectExpr("concat('f', id % 3) AS file_name")
    found = {r["file"]: r["revisions"] for r in revision_counts(rows).collect()}
    assert found == {"f0": 4, "f1": 3, "f2": 3, None: 10}


def test_only_dates_with_times_are_instants(spark):
    texts = ["2019-11-05T07:41:09Z", "2019-11-05T07:41:09.5+01:00", "2019", "2019-11", "07:41:09", "2019-11-05"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(to_instant(F.col("t")).alias("i"))
    assert [r.i is not None for r in rows.collect()] == [True, True, False, False, False, False]
