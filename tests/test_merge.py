import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.operators import merge
from tests.conftest import rows

FACT = "transacted_at timestamp_ntz, trx_id int, retailer_id int, description string, amount double, city_id int, emp_id bigint, record_hash string, year int, month int"
T1 = dt.datetime(2024, 1, 5)
T2 = dt.datetime(2024, 2, 5)


def fact(spark, data):
    return spark.createDataFrame(data, FACT)


def test_scd1_contract(spark):
    target = fact(
        spark,
        [
            (T1, 1, 1, "a", 1.0, 1, 1, "h1", 2024, 1),  # updated
            (T1, 2, 1, "b", 1.0, 1, 1, "h2", 2024, 1),  # unchanged
            (T1, 3, 1, "c", 1.0, 1, 1, "h3", 2024, 1),  # retained (target only)
        ],
    )
    staging = fact(
        spark,
        [
            (T2, 1, 9, "A", 2.0, 2, 2, "h1x", 2024, 2),  # changed: transacted_at/year/month stay
            (T1, 2, 1, "b", 1.0, 1, 1, "h2", 2024, 1),
            (T2, 4, 4, "d", 4.0, 4, 4, "h4", 2024, 2),  # insert
            (T1, 4, 4, "d-old", 4.0, 4, 4, "h4old", 2024, 1),  # repeated key: older loses
            (T2, None, 5, "e", 5.0, 5, 5, "h5", 2024, 2),  # null key
        ],
    )
    result = merge.merge_scd1(staging, target)
    got = {r.trx_id: r for r in result.merged.collect()}
    assert {k: got[k].change_type for k in got} == {1: "update", 2: "unchanged", 3: "retained", 4: "insert"}
    assert (got[1].retailer_id, got[1].description, got[1].record_hash) == (9, "A", "h1x")
    assert (got[1].transacted_at, got[1].year, got[1].month) == (T1, 2024, 1)
    assert got[4].description == "d"
    assert result.rejected.count() == 1
    inserted = merge.merge_scd1(staging, target, null_key="insert").merged
    assert inserted.filter(F.col("trx_id").isNull()).count() == 1


def test_scd1_idempotent(spark):
    target = fact(spark, [(T1, 1, 1, "a", 1.0, 1, 1, "h1", 2024, 1), (T1, 3, 1, "c", 1.0, 1, 1, "h3", 2024, 1)])
    staging = fact(spark, [(T2, 1, 9, "A", 2.0, 2, 2, "h1x", 2024, 2), (T2, 4, 4, "d", 4.0, 4, 4, "h4", 2024, 2)])
    once = merge.merge_scd1(staging, target).merged.drop("change_type")
    twice = merge.merge_scd1(staging, once).merged
    assert {r.change_type for r in twice.collect()} == {"unchanged", "retained"}
    assert rows(twice.drop("change_type")) == rows(once)


def test_scd1_on_duplicate_error(spark):
    staging = fact(spark, [(T1, 1, 1, "a", 1.0, 1, 1, "x", 2024, 1), (T2, 1, 1, "a", 1.0, 1, 1, "y", 2024, 2)])
    with pytest.raises(ValueError):
        merge.merge_scd1(staging, staging.limit(0), on_duplicate="error")


def test_scd1_one_join_in_plan(spark):
    target = fact(spark, [(T1, 1, 1, "a", 1.0, 1, 1, "h1", 2024, 1)])
    plan = merge.merge_scd1(target, target).merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") - plan.count("BroadcastNestedLoopJoin") <= 2  # one join (AQE lists it once or twice)
    assert "FullOuter" in plan


def test_snapshot_is_staging(spark):
    target = fact(spark, [(T1, 1, 1, "a", 1.0, 1, 1, "h1", 2024, 1), (T1, 3, 1, "c", 1.0, 1, 1, "h3", 2024, 1)])
    staging = fact(spark, [(T2, 1, 9, "A", 2.0, 2, 2, "h1x", 2024, 2), (T2, 4, 4, "d", 4.0, 4, 4, "h4", 2024, 2)])
    snap = merge.merge_scd1_snapshot(staging, target)
    assert rows(snap, "trx_id", "change_type") == [(1, "update"), (4, "insert")]


EMP = "emp_id int, name string, record_hash string, effective_start_date date, effective_end_date date, is_current boolean"
AS_OF = dt.date(2024, 6, 1)
OLD = dt.date(2024, 1, 1)


def test_scd2_contract_and_invariants(spark):
    target = spark.createDataFrame(
        [
            (1, "same", "a", OLD, None, True),
            (2, "old", "b", OLD, None, True),
            (3, "kept", "c", OLD, None, True),
            (2, "older", "z", dt.date(2023, 1, 1), OLD, False),
        ],
        EMP,
    )
    staging = spark.createDataFrame(
        [(1, "same", "a", AS_OF, None, True), (2, "new2", "b2", AS_OF, None, True), (4, "new", "d", AS_OF, None, True)], EMP
    )
    out = merge.merge_scd2(staging, target, AS_OF)
    got = rows(out, "emp_id", "name", "effective_start_date", "effective_end_date", "is_current", "change_type")
    assert got == sorted(
        [
            (1, "same", OLD, None, True, "unchanged"),
            (2, "old", OLD, AS_OF, False, "expired"),
            (2, "new2", AS_OF, None, True, "new_version"),
            (3, "kept", OLD, None, True, "retained"),
            (2, "older", dt.date(2023, 1, 1), OLD, False, "history"),
            (4, "new", AS_OF, None, True, "new"),
        ],
        key=lambda t: tuple((x is None, str(x)) for x in t),
    )
    # one current row per key; rerun with the same staging changes nothing
    current = out.filter("is_current").groupBy("emp_id").count()
    assert current.filter("count > 1").count() == 0
    again = merge.merge_scd2(staging, out.drop("change_type"), AS_OF)
    assert rows(again.drop("change_type")) == rows(out.drop("change_type"))
    assert again.filter(F.col("change_type").isin("new", "new_version", "expired")).count() == 0


def test_scd2_second_change_same_day_replaces(spark):
    target = spark.createDataFrame([(1, "v1", "a", AS_OF, None, True)], EMP)
    staging = spark.createDataFrame([(1, "v2", "b", AS_OF, None, True)], EMP)
    out = merge.merge_scd2(staging, target, AS_OF)
    assert rows(out, "name", "is_current") == [("v2", True)]


def test_scd2_one_join_in_plan(spark):
    target = spark.createDataFrame([(1, "a", "h", OLD, None, True), (1, "z", "y", dt.date(2023, 1, 1), OLD, False)], EMP)
    plan = merge.merge_scd2(target.filter("is_current"), target, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin") + plan.count("BroadcastHashJoin") == 1


def test_operators_chain_with_transform(spark):
    from starloom.operators import quality

    df = spark.createDataFrame([(1, "A", "X", "t", dt.date(1990, 1, 1), "a@b.c", "1", 1, 1)],
                               "src_id int, first_name string, last_name string, job_title string, dob date, email string, phone string, salary int, department_id int")
    out = df.transform(quality.clean_employees).transform(quality.flag_email).transform(quality.rank_employees)
    assert out.first()["row_num"] == 1 and out.first()["is_valid_email"] is True


def test_stored_null_keys_are_kept(spark):
    target = fact(spark, [(T1, 1, 1, "a", 1.0, 1, 1, "h1", 2024, 1), (T1, None, 5, "no key", 5.0, 5, 5, "h5", 2024, 1)])
    staging = fact(spark, [(T2, 1, 9, "A", 2.0, 2, 2, "h1x", 2024, 2)])
    got = merge.merge_scd1(staging, target).merged
    assert rows(got, "trx_id", "description", "change_type") == [(1, "A", "update"), (None, "no key", "retained")]
    dim = spark.createDataFrame([(None, "n", "x", OLD, None, True), (1, "a", "h", OLD, None, True)], EMP)
    new = spark.createDataFrame([(1, "b", "h2", AS_OF, None, True)], EMP)
    got = merge.merge_scd2(new, dim, AS_OF)
    assert rows(got, "emp_id", "name", "change_type") == [(1, "a", "expired"), (1, "b", "new_version"), (None, "n", "retained")]
