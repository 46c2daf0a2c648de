import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.functions.ranking import distributed_row_number
from tests.conftest import rows


def skewed(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        key = 0 if i % 3 == 0 else rnd.choice([1, 2, 3, None, 5, 6, 7])  # key 0 holds a third
        data.append((i, key, rnd.choice([None, 1, 2, 3, 4]), rnd.random()))
    return spark.createDataFrame(data, "id int, k int, a int, b double")


def test_partitioned_equals_window(spark):
    df = skewed(spark)
    order = [F.col("a").desc_nulls_last(), "b", "id"]
    w = Window.partitionBy("k").orderBy(F.col("a").desc_nulls_last(), "b", "id")
    expected = rows(df.withColumn("rn", F.row_number().over(w)), "id", "rn")
    got = rows(distributed_row_number(df, ["k"], order, out="rn", num_partitions=6), "id", "rn")
    assert got == expected


def test_global_equals_window(spark):
    df = skewed(spark, 1000)
    expected = rows(df.withColumn("rn", F.row_number().over(Window.orderBy("a", "id"))), "id", "rn")
    assert rows(distributed_row_number(df, [], ["a", "id"], out="rn", num_partitions=5), "id", "rn") == expected


def test_hot_key_spans_several_partitions(spark):
    from starloom.functions.ranking import range_numbered

    df = skewed(spark)
    ranged = range_numbered(df, ["k"], ["id"], num_partitions=6)
    per_range = ranged.filter("k = 0").groupBy("__pid").count().collect()
    assert len(per_range) > 1 and max(r["count"] for r in per_range) < 1000  # the hot key (1000 rows) is split


def test_no_single_partition_exchange_over_rows(spark):
    df = skewed(spark, 500)
    numbered = distributed_row_number(df, [], ["id"], out="rn", num_partitions=4)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    # the only single-partition exchange feeds the broadcast count table (one row per range partition)
    assert plan.count("Exchange SinglePartition") <= 1
    assert "BroadcastExchange" in plan
    assert numbered.rdd.getNumPartitions() == 4  # the numbered rows stay in their range partitions


def test_empty_input(spark):
    df = spark.createDataFrame([], "id int, k int")
    assert distributed_row_number(df, ["k"], ["id"]).count() == 0
