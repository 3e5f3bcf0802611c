import collections

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from ldspark.operators import salted_join, split_groups
from ldspark.operators.skew import hot_keys, sized_groups, spread_rows


def skewed(spark, n=900):
    """A third of all rows under one key."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
    return spark.range(n).select(key.alias("k"), F.col("id").alias("v"))


def test_only_heavy_keys_are_hot(spark):
    hot = hot_keys(skewed(spark), ["k"], ["v"], 50).collect()
    assert [r["parts"] for r in hot] == [6]
    assert hot_keys(skewed(spark), ["k"], ["v"], 300).count() == 0
    assert hot_keys(skewed(spark).limit(0), ["k"], ["v"], 1).count() == 0


def test_split_spreads_a_hot_key_and_leaves_the_others(spark):
    got = split_groups(skewed(spark), ["k"], ["v"], 50)
    sizes = collections.Counter((r["k"], r["part"]) for r in got.collect())
    hot = [n for (k, _), n in sizes.items() if k == "hot"]
    assert len(hot) == 6 and sum(hot) == 300 and max(hot) < 100
    assert {p for (k, p) in sizes if k != "hot"} == {0}


def test_split_is_the_same_when_it_runs_again(spark):
    first = rows(split_groups(skewed(spark), ["k"], ["v"], 50))
    again = rows(split_groups(skewed(spark).repartition(7), ["k"], ["v"], 50))
    assert first == again


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
@pytest.mark.parametrize("per_task", [10, 100, 10_000])
def test_salted_join_equals_a_plain_join(spark, how, per_task):
    left = skewed(spark).union(spark.sql("SELECT CAST(NULL AS STRING), -1L"))
    right = skewed(spark).select("k").distinct().filter("k <> 'k1'").withColumn("w", F.upper("k"))
    assert rows(salted_join(left, right, "k", ["v"], how, per_task).select(*sorted(
        ["k", "v"] + (["w"] if how != "left_semi" else [])
    ))) == rows(left.join(right, "k", how).select(*sorted(
        ["k", "v"] + (["w"] if how != "left_semi" else [])
    )))


def test_only_the_bounded_list_is_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        right = skewed(spark).select("k").distinct()
        text = plan(salted_join(skewed(spark), right, "k", ["v"], "inner", 10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_large_limits_count_a_share_only(spark):
    df = skewed(spark, 300_000)
    (row,) = hot_keys(df, ["k"], ["v"], 10_000).collect()
    assert 8 <= row["parts"] <= 12
    assert hot_keys(df, ["k"], ["v"], 200_000).count() == 0
    sizes = collections.Counter(
        r["part"] for r in split_groups(df, ["k"], ["v"], 10_000).filter("k = 'hot'").collect()
    )
    assert sum(sizes.values()) == 100_000 and max(sizes.values()) < 15_000


def test_rows_of_one_task_are_spread_and_stay_the_same(spark, tmp_path):
    """A file with one row group is one task; repeated rows and nulls stay."""
    null = F.when(F.col("id") % 10 > 0, F.col("id"))
    made = spark.range(1_000).select(null.alias("a"), F.lit("x").alias("b"))
    made.union(made).coalesce(1).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    got = spread_rows(df, 200)
    assert df.rdd.getNumPartitions() == 1 and got.rdd.getNumPartitions() == 10
    assert rows(got) == rows(df)
    assert max(collections.Counter(r[0] for r in got.select(F.spark_partition_id()).collect()).values()) < 600
    assert spread_rows(df, 2_000).rdd.getNumPartitions() == 1


def test_groups_ask_for_tasks_by_their_rows(spark):
    """Small groups that share a bin stay whole, the large one is still found."""
    with_nulls = F.when(F.col("k") != "k1", F.col("k"))
    got, tasks = sized_groups(skewed(spark, 1_200_000).withColumn("k", with_nulls), ["k"], ["v"], 100_000)
    sizes = {r["k"]: (r["parts"], r["n"]) for r in got.filter("part = 0").groupBy("k", "parts").agg(F.count("*").alias("n")).filter("n > 1").collect()}
    assert tasks == 3 and set(sizes) == {"hot"} and sizes["hot"][0] == 4
    assert sized_groups(skewed(spark, 0), ["k"], ["v"], 5)[1] == 1
