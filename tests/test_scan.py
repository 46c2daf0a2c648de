"""Running aggregates across range partitions against a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from starloom.functions.scan import FIRST, LAST, SUM, Running, running


def expected(data):
    out, state = [], {}
    for k, o, v in sorted(data, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        total, first, last = state.get(k, (None, None, None))
        if v is not None:
            total, first, last = (total or 0) + v, v if first is None else first, v
        state[k] = total, first, last
        out.append((k, o, v, total, first, last))
    return out


@pytest.mark.parametrize("keys,n", [(["a"], 5), (["a", "b", None], 4), ([f"k{i}" for i in range(60)], 6), (["a"] * 9 + ["z"], 16)])
def test_against_a_loop(spark, keys, n):
    rng = random.Random(len(keys))
    data = [(rng.choice(keys), i, rng.choice([None, 1, 2, 30])) for i in range(400)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k string, o int, v int").repartition(7)
    columns = {"total": Running(SUM, F.col("v")), "first": Running(FIRST, F.col("v")), "last": Running(LAST, F.col("v"))}
    got = [tuple(r) for r in running(df, ["k"], ["o"], columns, num_partitions=n).collect()]
    assert sorted(got, key=str) == sorted(expected(data), key=str)


def test_no_key_and_empty(spark):
    df = spark.createDataFrame([(i, 1) for i in range(100)], "o int, v int")
    got = running(df, [], ["o"], {"n": Running(SUM, F.col("v"))}, num_partitions=9).collect()
    assert all(r.n == r.o + 1 for r in got) and len(got) == 100
    assert running(df.limit(0), ["v"], ["o"], {"n": Running(SUM, F.col("v"))}).count() == 0


def test_a_hot_key_spans_tasks(spark):
    df = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").alias("o"), F.lit(1).alias("v"))
    got = running(df, ["k"], ["o"], {"n": Running(SUM, F.col("v"))}, num_partitions=8)
    assert got.filter("n = o + 1").count() == 20_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__pid" in plan and "hashpartitioning(k" not in plan
