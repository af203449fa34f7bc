"""Repeated ids against a plain grouping."""

import random

import pytest
from pyspark.sql import functions as F

from palimpsest.operators import quality, unique

SF = "/root/testdata/sf0.1"


def grouped(rows):
    found = rows.groupBy("id").agg(F.count("*").alias("copies")).where("copies > 1")
    return sorted(found.collect(), key=str)


def written(rows):
    """Bytes that the shuffles of a query write, from its plan's figures."""
    plan = rows._jdf.queryExecution().executedPlan()
    rows._jdf.collectAsList()

    def total(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return total(node.executedPlan())
        if kind == "ShuffleQueryStageExec":
            return total(node.plan())
        own = node.metrics().apply("shuffleBytesWritten").value() if kind == "ShuffleExchangeExec" else 0
        below = node.children()
        return own + sum(total(below.apply(k)) for k in range(below.size()))

    return total(plan)


@pytest.mark.parametrize("piece", [unique.PIECE, 40])
@pytest.mark.parametrize("run", [unique.RUN, 50])
def test_repeated_ids_equal_a_grouping(spark, run, piece):
    own = random.Random(5)
    top = 2**63 - 1
    ids = [own.randrange(-top, top) for _ in range(300)] + [own.randrange(5000) for _ in range(3000)]
    ids += [-1, -1, 0, 0, 2**23, 2**23 - 1, 2**23, top, top, -top - 1, -top - 1, None, None, 10**12] + [7] * 4000
    own.shuffle(ids)
    rows = spark.createDataFrame([(i,) for i in ids], "id long").repartition(6)
    assert sorted(unique.repeated_numbers(rows, "id", run, piece).collect(), key=str) == grouped(rows)


def test_nothing_repeats(spark):
    assert quality.duplicate_ids(spark.range(100_000)).count() == 0
    assert quality.duplicate_ids(spark.range(0)).count() == 0
    assert quality.duplicate_ids(spark.createDataFrame([(None,)], "id long")).count() == 0


def test_types_are_kept(spark):
    for kind in ("int", "bigint", "smallint", "string"):
        rows = spark.range(9).select((F.col("id") % 4).cast(kind).alias("id"))
        found = quality.duplicate_ids(rows)
        assert found.schema["id"].dataType.simpleString() == kind and sorted(found.collect(), key=str) == grouped(rows)


def test_little_is_shuffled(spark):
    conversations = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = conversations.select((F.col("conv_id") * 1_000_000 + F.col("turn") + 1).alias("id"))
    plain = rows.groupBy("id").agg(F.count("*").alias("copies")).where("copies > 1")
    assert 5 * written(quality.duplicate_ids(rows)) <= written(plain)
