import datetime as dt

from pyspark.sql import functions as F

from starloom.functions.hashing import record_hash, strict_hash
from starloom.operators import dims, facts
from tests.conftest import rows


def test_city_dim_survivor_is_deterministic(spark):
    cities = spark.createDataFrame(
        [(1, "B", "S", "x", "C"), (1, "A", "S", None, "C"), (1, "A", "S", "y", "C"), (2, "Z", "S", "z", "C"), (None, "N", "S", "n", "C")],
        "city_id int, city string, state string, state_abv string, country string",
    )
    got = rows(dims.city_dim(cities))
    assert got == [(1, "A", "S", None, "C"), (2, "Z", "S", "z", "C"), (None, "N", "S", "n", "C")]


def test_date_dim_drops_nulls_and_keeps_stored(spark):
    sales = spark.createDataFrame(
        [(dt.datetime(2024, 3, 31, 23, 59, 59, 999999),), (None,), (dt.datetime(2024, 3, 31, 1),)], "transacted_at timestamp_ntz"
    )
    dd = dims.date_dim(sales)
    assert rows(dd) == [(dt.date(2024, 3, 31), 31, 3, 2024, 1)]
    stored = spark.createDataFrame([(dt.date(2023, 12, 1), 1, 12, 2023, 4)], "date date, day int, month int, year int, quarter int")
    assert dims.date_dim(sales, stored=stored).count() == 2
    assert dims.date_dim(sales.limit(0)).count() == 0


def test_keys_are_dense_and_stable(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, None)], "k int, v string")
    first = dims.assign_keys(df, ["k", "v"])
    assert rows(first.rows, "k", "emp_id") == [(1, 1), (2, 2), (3, 3)]
    stored = first.new_keys
    later = spark.createDataFrame([(0, "z"), (2, None), (9, "q")], "k int, v string")
    second = dims.assign_keys(later, ["k", "v"], stored)
    assert rows(second.rows, "k", "emp_id") == [(0, 4), (2, 2), (9, 5)]  # known key keeps 2, new keys continue
    assert second.new_keys.count() == 2


def test_assign_employee_edges(spark):
    sales = spark.createDataFrame([(None,), (5,), (-2147483648,)], "trx_id int")
    employees = spark.range(7)
    got = dict(rows(facts.assign_employee(sales, employees), "trx_id", "emp_id"))
    assert got[None] == 42 % 7 + 1  # hash(null) is the seed
    expected5 = spark.range(1).select((F.abs(F.hash(F.lit(5).cast("int")).cast("long")) % 7 + 1).alias("e")).first()["e"]
    assert got[5] == expected5
    assert all(v is not None and 1 <= v <= 7 for v in got.values())
    none = facts.assign_employee(sales, spark.range(0))
    assert {r["emp_id"] for r in none.collect()} == {None}


def test_hash_int_and_bigint_differ(spark):
    r = spark.range(1).select(F.hash(F.lit(1).cast("int")).alias("i"), F.hash(F.lit(1).cast("bigint")).alias("l")).first()
    assert r.i != r.l  # why the declared key type matters for the assignment


def test_record_hash_collision_and_strict_hash(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a||b", None), ("a", "b")], "x string, y string")
    out = df.select(record_hash(["x", "y"]).alias("h"), strict_hash(["x", "y"]).alias("s")).collect()
    assert out[0].h == out[1].h  # concat_ws skips nulls
    assert out[2].h == out[3].h  # separator inside a value
    assert len({r.s for r in out}) == 4  # strict hash tells all four apart


def test_batch_max_and_day_mark(spark):
    sales = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5),), (None,)], "transacted_at timestamp_ntz")
    r = facts.batch_max(sales).first()
    assert r.max_ts == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert r.day_mark == dt.datetime(2024, 1, 2, 23, 59, 59, 999999)
    empty = facts.batch_max(sales.limit(0)).first()
    assert empty.max_ts is None and empty.day_mark is None


def test_enrich_join_types(spark):
    sales = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "trx_id int, city_id int")
    cities = spark.createDataFrame([(10, "x")], "city_id int, city string")
    assert rows(facts.enrich_with_city(sales, cities), "trx_id", "city") == [(1, "x")]
    assert [r[0] for r in rows(facts.enrich_with_city(sales, cities, "left_anti"), "trx_id")] == [2, 3]
    assert facts.enrich_with_city(sales, cities, "left").count() == 3
    assert facts.enrich_with_city(sales, cities).columns.count("city_id") == 1
