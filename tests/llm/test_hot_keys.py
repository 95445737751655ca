"""One key holds a third of all rows: joins of facts about keys are split by adaptive execution."""

import pytest
from pyspark.sql import functions as F

from colonnade.llm.common import join_hot


@pytest.fixture
def small_thresholds(conf):
    """Treat partitions of a few kilobytes the way a cluster treats hundreds of megabytes."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__maxShuffledHashJoinLocalMapThreshold="0",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="4KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="2KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="12",
    )


@pytest.mark.parametrize("hot", ["digest", "center"])
def test_a_hot_key_is_split(spark, small_thresholds, hot):
    """A digest held by a third of all documents, and the links of a star with a third of all nodes."""
    key = F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
    rows = spark.range(30_000, numPartitions=8).select(key.alias("key"), "id", F.sha2(F.col("id").cast("string"), 256).alias("load"))
    least = rows.groupBy("key").agg(F.min("id").alias("least"))
    joined = join_hot(rows, least, "key", "id")
    got = joined.agg(F.count(F.lit(1)), F.sum("least"), F.max(F.when(F.col("key") == hot, F.col("least"))))
    # Of k0 to k4999, each number is first met at itself unless that is a multiple of 3: then 5,000 or 10,000 later.
    first = {}
    for i in range(30_000):
        first.setdefault(hot if i % 3 == 0 else f"k{i % 5000}", i)
    want = sum(first[hot if i % 3 == 0 else f"k{i % 5000}"] for i in range(30_000))
    assert tuple(got.first()) == (30_000, want, 0)
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    in_place = rows.join(least, "key")
    in_place.collect()
    assert "skew=true" not in in_place._jdf.queryExecution().executedPlan().toString()


def test_null_keys_meet_nothing_and_columns_stay(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (None, "a")], "id long, key string")
    facts = spark.createDataFrame([("a", 7), (None, 8)], "key string, fact int")
    got = join_hot(rows, facts, "key", "id")
    assert sorted(got.columns) == ["fact", "id", "key"]
    assert sorted((r.id or 0, r.fact) for r in got.collect()) == [(0, 7), (1, 7)]
    assert join_hot(rows, facts.limit(0), "key", "id").count() == 0
