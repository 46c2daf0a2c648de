"""As-of join, moving sums, sessions and grouped totals against plain loops."""

import datetime as dt
import random
import re
from collections import defaultdict
from decimal import Decimal
from itertools import product

import pytest
from pyspark.sql import functions as F

from starloom.operators import temporal, totals

DAY = dt.timedelta(days=1)
T0 = dt.datetime(2024, 1, 1)


def money():
    return F.col("v").cast("decimal(18,2)")



def at(rng, days=60):
    return T0 + rng.randrange(days) * DAY if rng.random() > 0.05 else None


@pytest.mark.parametrize("n,inclusive", [(1, True), (6, True), (6, False)])
def test_as_of_join(spark, n, inclusive):
    rng = random.Random(n)
    left = [(rng.choice(["hot"] * 5 + ["b", "c", None]), at(rng), i % 50) for i in range(300)]
    right = [(rng.choice(["hot", "hot", "b", "z", None]), at(rng), i, rng.choice([None, T0 + rng.randrange(80) * DAY])) for i in range(60)]
    got = temporal.as_of_join(
        spark.createDataFrame(left, "k string, at timestamp_ntz, i int"), spark.createDataFrame(right, "k string, since timestamp_ntz, x int, until timestamp_ntz"),
        ["k"], "at", "since", ["x", "since"], until="until", inclusive=inclusive, num_partitions=n,
    )
    want = []
    for k, t, i in left:
        fits = [r for r in right if k is not None and t is not None and r[0] == k and r[1] is not None and (r[1] <= t if inclusive else r[1] < t)]
        found = max(fits, key=lambda r: (r[1], r[2]), default=None)
        if found and found[3] is not None and t >= found[3]:
            found = None
        want.append((k, t, i, found and found[2], found and found[1]))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_as_of_join_of_empty_tables(spark):
    left = spark.createDataFrame([("a", T0)], "k string, at timestamp_ntz")
    right = spark.createDataFrame([("a", T0.date(), 1)], "k string, since date, x int")
    assert [r.x for r in temporal.as_of_join(left, right.limit(0), ["k"], "at", "since", ["x"]).collect()] == [None]
    assert temporal.as_of_join(left.limit(0), right, ["k"], "at", "since", ["x"]).count() == 0
    assert [r.x for r in temporal.as_of_join(left, right, ["k"], "at", "since", ["x"]).collect()] == [1]  # a date is its midnight


@pytest.mark.parametrize("n", [1, 7])
def test_moving_sums(spark, n):
    rng = random.Random(n)
    data = [(rng.choice(["hot"] * 4 + ["b", None]), at(rng), rng.choice([None, 1.5, 2.25, -3.0])) for _ in range(300)]
    got = temporal.moving_sums(spark.createDataFrame(data, "k string, at timestamp_ntz, v double"), ["k"], "at", money(), "7 days", n)
    want = set()
    for k, t in {(k, t) for k, t, _ in data}:
        inside = [v for k2, t2, v in data if k2 == k and (t2 is None if t is None else t2 is not None and t - 7 * DAY <= t2 <= t)]
        some = [Decimal(str(v)) for v in inside if v is not None]
        want.add((k, t, len(inside), sum(some) if some else None))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((k, t, m, None if s is None else s.quantize(Decimal("0.01"))) for k, t, m, s in want), key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(k#\d+, \d+\)", plan) and "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("n", [1, 5])
def test_sessions(spark, n):
    rng = random.Random(n)
    data = [(rng.choice(["hot"] * 4 + ["b", None]), at(rng, 200), 1.0) for _ in range(150)]
    data += data[:5]
    df = spark.createDataFrame(data, "k string, at timestamp_ntz, v double")
    got = temporal.sessions(df, ["k"], "at", "3 days", money(), n)
    want, by_key = [], defaultdict(list)
    for k, t, _ in data:
        if t is not None:
            by_key[k].append(t)
    for k, times in by_key.items():
        group = []
        for t in sorted(times):
            if group and t - group[-1] > 3 * DAY:
                want.append((k, group[0], group[-1], len(group)))
                group = []
            group.append(t)
        want.append((k, group[0], group[-1], len(group)))
    assert sorted(map(tuple, got.drop("total").collect()), key=str) == sorted(want, key=str)
    # Spark's own session windows agree
    own = df.groupBy("k", F.session_window("at", "3 days")).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("start"))
    assert sorted((str(r.k), r.start, r.n) for r in own.collect()) == sorted((str(k), s, m) for k, s, _, m in want)


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "k string, at timestamp_ntz, v double")
    assert temporal.moving_sums(empty, ["k"], "at", money(), "7 days").count() == 0
    assert temporal.sessions(empty, ["k"], "at", "3 days", money()).count() == 0
    assert totals.grouped_totals(empty, ["k"], money()).count() == 0


@pytest.mark.parametrize("sets", [totals.CUBE, totals.ROLLUP, [["a", "b"], ["b"], []]])
def test_grouped_totals(spark, sets):
    rng = random.Random(1)
    data = [(rng.choice(["x", "y", None]), rng.choice([1, 2, None]), rng.choice([1.5, None, 2.0])) for _ in range(100)]
    got = totals.grouped_totals(spark.createDataFrame(data, "a string, b int, v double"), ["a", "b"], money(), sets)
    chosen = {totals.CUBE: [["a", "b"], ["a"], ["b"], []], totals.ROLLUP: [["a", "b"], ["a"], []]}.get(sets if isinstance(sets, str) else "", sets)
    want = []
    for s in chosen:
        bits = 2 * ("a" not in s) + ("b" not in s)
        for key in set(product([d[0] for d in data] if "a" in s else [None], [d[1] for d in data] if "b" in s else [None])):
            inside = [v for a, b, v in data if ("a" not in s or a == key[0]) and ("b" not in s or b == key[1])]
            some = [v for v in inside if v is not None]
            if inside:
                want.append((key[0], key[1], bits, len(inside), f"{sum(some):.2f}" if some else "None"))
    assert sorted(((r.a, r.b, r.grouping, r.n, str(r.total)) for r in got.collect()), key=str) == sorted(want, key=str)
