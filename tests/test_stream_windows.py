"""Event-time streams on small deliveries: late rows, repeats, nulls, empty deliveries, restarts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.session import scratch_path
from starloom.sources.io import WriteMode, read_table, write_table
from starloom.streaming import windows

T0 = dt.datetime(2024, 1, 1)
HOUR = dt.timedelta(hours=1)
SALES = "k string, at timestamp, v int"


def deliver(spark, root, deliveries, make, schemas):
    """Each delivery is a run of its own, from the checkpoint of the one before. Returns the last run's drops."""
    dropped = 0
    for parts in deliveries:
        for name, rows in parts.items():
            write_table(spark.createDataFrame(rows, schemas[name]), f"{root}/{name}", mode=WriteMode.APPEND, rebalance=False)
        streams = [windows.arriving(spark, f"{root}/{name}", spark.createDataFrame([], schema).schema) for name, schema in schemas.items()]
        query = windows.appended(make(*streams), f"{root}/out", f"{root}/checkpoint")
        query.awaitTermination()
        dropped += sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    return dropped


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hourly_totals_with_late_rows(spark):
    root = scratch_path(spark, "t-hourly")
    at = lambda h, m=0: T0 + h * HOUR + dt.timedelta(minutes=m)
    first = [("a", at(0), 1), ("a", at(0, 59), 2), ("a", at(0, 59), 2), (None, at(1), 5), ("b", None, 7), ("a", at(10), None)]
    second = [("a", at(0, 30), 100), ("c", at(3), 9), ("a", at(9, 30), 4), ("a", at(30), 8)]  # two of them late
    total = F.col("v").cast("bigint")
    make = lambda s: windows.window_totals(s, ["k"], "at", total, "2 hours")
    dropped = deliver(spark, root, [{"s": first}, {"s": []}, {"s": second}], make, {"s": SALES})
    assert dropped == 2
    emitted = read_table(spark, f"{root}/out")
    assert emitted.groupBy("k", "start").count().filter("count > 1").count() == 0
    source = read_table(spark, f"{root}/s", schema=SALES)
    found = windows.late_totals(source, emitted, ["k"], "at", total, F.lit(at(28)))
    got = sorted(((r.k, (r.start - T0) // HOUR, r.n, r.total, r.n_late, r.total_late) for r in found.collect()), key=str)
    assert got == sorted([("a", 0, 3, 5, 1, 100), (None, 1, 1, 5, 0, 0), ("c", 3, 0, 0, 1, 9), ("a", 9, 1, 4, 0, 0), ("a", 10, 1, 0, 0, 0)], key=str)


def test_first_rows_across_restarts(spark):
    root = scratch_path(spark, "t-first")
    day = lambda d: T0 + d * 24 * HOUR
    deliveries = [
        {"s": [("a", day(0), 1), ("a", day(0), 1), ("b", day(1), 2), (None, day(1), 3), ("n", None, 4)]},
        {"s": [("a", day(2), 5), ("c", day(3), 6), (None, day(2), 7)]},  # a and null are remembered
        {"s": [("d", day(60), 8)]},
        {"s": [("a", day(61), 9)]},  # forgotten by now: a first row again
    ]
    deliver(spark, root, deliveries, lambda s: windows.first_rows(s, ["k"], "at", "10 days"), {"s": SALES})
    got = [(r.k, (r.at - T0).days) for r in read_table(spark, f"{root}/out").collect()]
    assert sorted(got, key=str) == sorted([("a", 0), ("b", 1), (None, 1), ("c", 3), ("d", 60), ("a", 61)], key=str)


def test_corrections_meet_their_sales(spark):
    root = scratch_path(spark, "t-corrections")
    day = lambda d: T0 + d * 24 * HOUR
    schemas = {"sales": SALES, "changes": "k string, changed timestamp, w int"}
    deliveries = [
        {"sales": [("a", day(0), 1), ("b", day(0), 2), (None, day(0), 3), ("n", None, 4)], "changes": [("a", day(1), 10), (None, day(1), 30), ("b", day(8), 20)]},
        {"sales": [("c", day(5), 5)], "changes": [("a", day(7), 11), ("c", day(4), 50), ("c", day(5), 51), ("c", day(5), 51), ("n", day(1), 40)]},
    ]
    make = lambda s, c: windows.corrections(s, c, "k", "at", "changed", "7 days", "30 days")
    deliver(spark, root, deliveries, make, schemas)
    got = sorted((r.k, r.v, r.w) for r in read_table(spark, f"{root}/out").collect())
    assert got == [("a", 1, 10), ("a", 1, 11), ("c", 5, 51), ("c", 5, 51)]
