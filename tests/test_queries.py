import pytest

import __spark_entry__ as driver
from checks.compare import connect, differences
from checks.expected import EXPECTED
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, name):
    result = driver.queries()[name](spark, SF)
    assert differences(result, database, driver.oracle_sql()[name]) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(EXPECTED)
    assert set(QUERIES) <= set(driver.queries()) and set(EXPECTED) <= set(driver.oracle_sql())


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns == ["page_id", "page_title", "revisions"]
    assert result.count() > 0
