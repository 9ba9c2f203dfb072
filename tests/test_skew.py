"""A key holding a third of the rows is split, and the rows stay whole."""

import pytest
from pyspark.sql import functions as F

from starloom.operators.categorize import categorize
from starloom.operators.duplicates import duplicate_rows
from starloom.operators.joins import Lookup, lookup_default, not_in, orphan_rows, resolve_keys

N = 60_000
SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield spark.range(0, N, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def executed(df):
    """Result rows and whether AQE split a join side."""
    count = df.count()
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return count, df._jdf.queryExecution().executedPlan().toString()


def dims(spark):
    return spark.range(0, N, 5).selectExpr("id + 1 as key", "concat('m', id) as name", "1 as is_current")


@pytest.mark.parametrize("op", ["not_in", "lookup", "orphans", "resolve"])
def test_hot_key_is_split(spark, skewed, op):
    ref = dims(spark)
    known = ref.where("key <> 1")
    df, expected = {
        "not_in": lambda: (
            not_in(skewed, known.withColumnRenamed("key", "k"), ["k"]),
            skewed.where("k = 1 or k % 5 <> 1").count(),
        ),
        "lookup": lambda: (
            lookup_default(skewed, ref.withColumnRenamed("key", "k"), "k", "name", "?", order=["name"]),
            N,
        ),
        "orphans": lambda: (
            orphan_rows(skewed, known, "k", "key"),
            skewed.where("k = 1 or k % 5 <> 1").count(),
        ),
        "resolve": lambda: (resolve_keys(skewed, [Lookup(ref, [("k", "key")], {"name": "name"})]), N),
    }[op]()
    count, plan = executed(df)
    assert count == expected
    assert "skew=true" in plan, plan[:3000]


def test_hot_duplicates_are_split(spark, skewed):
    # Pairs as well, so that the repeated keys are no handful.
    df = skewed.union(skewed.where("k % 2 = 0"))
    count, plan = executed(duplicate_rows(df, ["k"]))
    assert count == skewed.where("k = 1").count() + 2 * skewed.where("k % 2 = 0").count()
    assert "skew=true" in plan, plan[:3000]


def test_hot_text_is_split_when_categorized(spark, skewed):
    texts = skewed.select(F.concat(F.lit("m"), "k").alias("text"), "payload")
    mapping = spark.range(0, N, 5).selectExpr("concat('m', id + 1) as value", "'c' as category", "1 as rank")
    count, plan = executed(categorize(texts, "text", mapping))
    assert count == N
    assert "skew=true" in plan, plan[:3000]


def test_rows_are_not_shuffled_for_few_repeated_keys(spark):
    """Their size is known before the rows are read, so these stay where they are."""
    df = spark.range(0, 5_000, numPartitions=4).select((F.col("id") % 4_990).alias("k"), "id")
    count, plan = executed(duplicate_rows(df, ["k"]))
    assert count == 20 and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
