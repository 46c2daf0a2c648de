import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.operators import control
from starloom.plans import batch, publish, queries
from starloom.plans import fixtures as fx
from starloom.plans.store import Run, Store
from starloom.session import scratch_path
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
LOOKBACK = dt.timedelta(days=365)


def run(spark, root, n, as_of=fx.AS_OF):
    emp, sales, cities = fx.batch_inputs(spark, SF, n)
    lookback = LOOKBACK if n == 2 else None
    return batch.run_batch(spark, emp, sales, cities, root, as_of, lookback=lookback, tie_breakers=["src_id"])


def snapshot(spark, root):
    return {t: rows(batch.published(spark, root, t)) for t in ("sales_fact", "employee_dim", "date_dim", "city_dim", "key_map")}


def test_first_load_then_skip(spark):
    root = scratch_path(spark, "t-batch")
    first = run(spark, root, 1)
    assert first.decision == "first_load"
    assert first.metrics["fact_rows"] == batch.published(spark, root, "sales_fact").count()
    assert first.metrics["input_rows"] == first.metrics["valid_rows"] + first.metrics["bad_rows"]
    again = run(spark, root, 1)
    assert again.decision == "skip"
    fact = batch.published(spark, root, "sales_fact")
    assert fact.groupBy("trx_id").count().filter("count > 1").count() == 0
    dim = batch.published(spark, root, "employee_dim")
    assert dim.filter("is_current").groupBy("emp_id").count().filter("count > 1").count() == 0


def test_incremental_and_crash_replay(spark, monkeypatch):
    clean = scratch_path(spark, "t-clean")
    run(spark, clean, 1)
    outcome = run(spark, clean, 2, fx.AS_OF + dt.timedelta(days=1))
    assert outcome.decision == "incremental"
    assert outcome.metrics["fact_insert"] > 0 and outcome.metrics["fact_update"] > 0
    expected = snapshot(spark, clean)

    crashed = scratch_path(spark, "t-crash")
    run(spark, crashed, 1)
    before = snapshot(spark, crashed)

    def boom(*a, **k):
        raise RuntimeError("lost before the commit")

    monkeypatch.setattr(Run, "commit", boom)
    with pytest.raises(RuntimeError):
        run(spark, crashed, 2, fx.AS_OF + dt.timedelta(days=1))
    monkeypatch.undo()
    assert snapshot(spark, crashed) == before
    # and inside each of the writes
    lost = queries.crashing_loads(
        spark, fx.batch_inputs(spark, SF, 2), crashed, day=1, lookback=LOOKBACK
    )
    assert lost == 7  # audit, key map, cities, rejects, fact, employees, dates
    assert snapshot(spark, crashed) == expected

    dim = batch.published(spark, clean, "employee_dim")
    assert dim.filter("is_current").groupBy("emp_id").count().filter("count > 1").count() == 0
    # surrogate keys of the first run are kept in the second
    assert batch.published(spark, clean, "key_map").groupBy("emp_id").count().filter("count > 1").count() == 0


def test_stream_equals_batch_merge(spark):
    streamed = queries.stream_scd1_merge(spark, SF)
    batch_merged = queries.scd1_merge(spark, SF)
    assert rows(streamed.select(*batch_merged.columns)) == rows(batch_merged)


def test_stream_replay_is_noop(spark):
    from starloom.plans.queries import _scd1_side

    root = scratch_path(spark, "t-upsert")
    staging = _scd1_side(fx.sales_after(spark, SF))
    staging = staging.unionByName(staging.limit(3).withColumn("trx_id", F.lit(None).cast("int")))
    publish.upsert_batch(spark, root, _scd1_side(fx.sales_before(spark, SF)), batch="b0")
    first = publish.upsert_batch(spark, root, staging, batch="b1")
    assert first["insert"] > 0
    once = rows(batch.published(spark, root, "sales_fact"))
    for _ in range(2):
        assert publish.upsert_batch(spark, root, staging, batch="b1") == {"insert": 0, "update": 0}
    assert rows(batch.published(spark, root, "sales_fact")) == once
    assert batch.published(spark, root, "sales_fact_rejects").count() == 3


def test_day_granularity_mark_and_email_key(spark):
    root = scratch_path(spark, "t-day")
    emp, sales, cities = fx.batch_inputs(spark, SF, 1)
    out = batch.run_batch(
        spark, emp, sales, cities, root, fx.AS_OF, tie_breakers=["src_id"], mark_granularity="day", natural_key=["email"]
    )
    assert out.batch_max.time() == dt.time(23, 59, 59, 999999)
    dim = batch.published(spark, root, "employee_dim")
    assert dim.groupBy("email").count().filter("count > 1").count() == 0
    assert control.latest_marks(Store(spark, root).control()).first()["mark_value"] == out.batch_max


def test_stream_late_rows_are_merged_not_dropped(spark):
    from starloom.plans.queries import _scd1_side
    from starloom.sources.io import WriteMode, write_table
    from starloom.streaming.merge_stream import stream_upsert

    schema = "transacted_at timestamp_ntz, trx_id int, retailer_id int, description string, amount double, city_id int"
    root = scratch_path(spark, "t-late")
    first = spark.createDataFrame(
        [(dt.datetime(2024, 3, 1), 1, 1, "a", 1.0, 1), (dt.datetime(2024, 3, 2), 2, 1, "b", 2.0, 1)], schema
    )
    late = spark.createDataFrame(
        [
            (dt.datetime(2023, 1, 1), 3, 1, "late", 3.0, 1),  # far behind the stream's event time
            (dt.datetime(2024, 3, 5), 2, 1, "b-new", 2.5, 1),  # same key twice in one micro-batch:
            (dt.datetime(2024, 3, 4), 2, 1, "b-old", 2.4, 1),  # the latest transacted_at wins
        ],
        schema,
    )
    write_table(first.coalesce(1), f"{root}/in", mode=WriteMode.APPEND, rebalance=False)
    write_table(late.coalesce(1), f"{root}/in", mode=WriteMode.APPEND, rebalance=False)
    q = stream_upsert(spark, f"{root}/in", first.schema, f"{root}/out", f"{root}/ckpt", prepare=_scd1_side, max_files_per_trigger=1)
    q.awaitTermination()
    got = {r.trx_id: r.description for r in batch.published(spark, f"{root}/out", "sales_fact").collect()}
    assert got == {1: "a", 2: "b-new", 3: "late"}


def test_first_load_rejects_null_keys_and_keeps_one_row_per_key(spark):
    schema = "transacted_at timestamp_ntz, trx_id int, retailer_id int, description string, amount double, city_id int"
    sales = spark.createDataFrame(
        [
            (dt.datetime(2024, 1, 1), 1, 1, "old", 1.0, 1),
            (dt.datetime(2024, 1, 2), 1, 1, "new", 1.0, 1),
            (dt.datetime(2024, 1, 3), None, 1, "no key", 1.0, 1),
            (dt.datetime(2024, 1, 4), 2, 1, "x", 1.0, 1),
        ],
        schema,
    )
    emp, _, cities = fx.batch_inputs(spark, SF, 1)
    root = scratch_path(spark, "t-keys")
    out = batch.run_batch(spark, emp, sales, cities, root, fx.AS_OF, tie_breakers=["src_id"])
    fact = {r.trx_id: r.description for r in batch.published(spark, root, "sales_fact").collect()}
    assert fact == {1: "new", 2: "x"}
    assert [r.description for r in batch.published(spark, root, "rejects").collect()] == ["no key"]
    assert out.metrics["sales_rows"] == 2 and out.metrics["fact_rows"] == 2


def test_scd2_in_batch_rewrites_touched_departments_only(spark):
    import glob

    emp_schema = "first_name string, last_name string, job_title string, dob date, email string, phone string, salary int, department_id int"
    sales_schema = "transacted_at timestamp_ntz, trx_id int, retailer_id int, description string, amount double, city_id int"
    cities = spark.createDataFrame([(1, "c", "s", "ab", "X")], "city_id int, city string, state string, state_abv string, country string")
    d = dt.date(1990, 1, 1)
    run1 = spark.createDataFrame(
        [("A", "a", "t", d, "a@x.y", "1", 10, 1), ("B", "b", "t", d, "b@x.y", "2", 10, 2), ("C", "c", "t", d, "c@x.y", "3", 10, 3)],
        emp_schema,
    )
    run2 = spark.createDataFrame(
        [
            ("A", "a", "t", d, "a@x.y", "1", 99, 1),  # salary change, same department
            ("B", "b", "t", d, "b@x.y", "2", 10, 4),  # transfer 2 -> 4 (identity = e-mail)
            ("C", "c", "t", d, "c@x.y", "3", 10, 3),  # unchanged, department 3 untouched
            ("D", "d", "t", d, "d@x.y", "5", 10, 1),  # new hire
        ],
        emp_schema,
    )
    s1 = spark.createDataFrame([(dt.datetime(2024, 1, 1), 1, 1, "x", 1.0, 1)], sales_schema)
    s2 = spark.createDataFrame([(dt.datetime(2024, 2, 1), 2, 1, "y", 1.0, 1)], sales_schema)
    root = scratch_path(spark, "t-scd2-batch")
    batch.run_batch(spark, run1, s1, cities, root, dt.date(2024, 1, 1), natural_key=["email"])
    files = lambda: sorted(glob.glob(f"{root.replace('file:', '')}/employee_dim/*/department_id=3/*.parquet"))
    untouched = files()
    assert untouched
    out = batch.run_batch(spark, run2, s2, cities, root, dt.date(2024, 2, 1), natural_key=["email"])
    assert out.decision == "incremental"
    dim = batch.published(spark, root, "employee_dim")
    got = rows(dim, "email", "department_id", "salary", "is_current", "effective_end_date")
    assert got == rows(
        spark.createDataFrame(
            [
                ("a@x.y", 1, 10, False, dt.date(2024, 2, 1)),
                ("a@x.y", 1, 99, True, None),
                ("b@x.y", 2, 10, False, dt.date(2024, 2, 1)),
                ("b@x.y", 4, 10, True, None),
                ("c@x.y", 3, 10, True, None),
                ("d@x.y", 1, 10, True, None),
            ],
            "email string, department_id int, salary int, is_current boolean, effective_end_date date",
        )
    )
    assert files() == untouched
    assert out.metrics["employee_new_version"] == 2 and out.metrics["employee_new"] == 1


def test_strict_hash_detects_moved_nulls(spark):
    sales_schema = "transacted_at timestamp_ntz, trx_id int, retailer_id int, description string, amount double, city_id int"
    emp, _, cities = fx.batch_inputs(spark, SF, 1)
    s1 = spark.createDataFrame([(dt.datetime(2024, 1, 1), 1, None, "7", 1.0, 1)], sales_schema)
    # same concatenation "7||1.0||1||emp" once the null moves: record_hash equal, strict_hash differs
    s2 = spark.createDataFrame([(dt.datetime(2024, 1, 1), 1, 7, None, 1.0, 1), (dt.datetime(2024, 2, 1), 2, 1, "x", 1.0, 1)], sales_schema)
    results = {}
    for change_on in ("record_hash", "strict_hash"):
        root = scratch_path(spark, f"t-{change_on}")
        batch.run_batch(spark, emp, s1, cities, root, fx.AS_OF, tie_breakers=["src_id"], change_on=change_on)
        out = batch.run_batch(
            spark, emp, s2, cities, root, fx.AS_OF, tie_breakers=["src_id"], change_on=change_on, lookback=dt.timedelta(days=60)
        )
        row = batch.published(spark, root, "sales_fact").filter("trx_id = 1").first()
        results[change_on] = (out.metrics["fact_update"], row.retailer_id, row.description)
    assert results["record_hash"] == (0, None, "7")  # the compatible hash cannot see the change
    assert results["strict_hash"] == (1, 7, None)


SALES = "transacted_at timestamp_ntz, trx_id int, retailer_id int, description string, amount double, city_id int"
EMP = "first_name string, last_name string, job_title string, dob date, email string, phone string, salary int, department_id int"
CITY = "city_id int, city string, state string, state_abv string, country string"


def load(spark, root, day, sales, people=None, cities=None, **options):
    people = people or [("A", "a", "t", dt.date(1990, 1, 1), "a@x.y", "1", 10, 1)]
    return batch.run_batch(
        spark, spark.createDataFrame(people, EMP), spark.createDataFrame(sales, SALES), spark.createDataFrame(cities or [(1, "c", "s", "ab", "X")], CITY),
        root, dt.date(2024, 1, day), **options,
    )


def test_undated_and_late_sales_are_loaded(spark):
    root = scratch_path(spark, "t-late")
    week = dt.timedelta(days=7)
    load(spark, root, 1, [(dt.datetime(2024, 1, 10), 1, 1, "a", 1.0, 1)])
    out = load(spark, root, 2, [(dt.datetime(2024, 1, 8), 2, 1, "late", 1.0, 1), (None, 3, 1, "undated", 1.0, 1)], lookback=week)
    assert out.decision == "incremental" and out.metrics["fact_insert"] == 2
    fact = {r.trx_id: r.description for r in batch.published(spark, root, "sales_fact").collect()}
    assert fact == {1: "a", 2: "late", 3: "undated"}
    marks = control.latest_marks(Store(spark, root).control()).first()
    assert (marks.mark_value, marks.seq) == (dt.datetime(2024, 1, 10), 2)  # never moved back
    assert load(spark, root, 3, [(dt.datetime(2024, 1, 2), 4, 1, "too late", 1.0, 1)], lookback=week).decision == "skip"


def test_city_that_moves_and_aborted_first_load(spark, monkeypatch):
    root = scratch_path(spark, "t-city")
    sale = [(dt.datetime(2024, 1, 1), 1, 1, "a", 1.0, 1)]
    monkeypatch.setattr(Run, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        load(spark, root, 1, [(dt.datetime(2023, 5, 1), 1, 1, "aborted", 1.0, 1)], people=[("Z", "z", "t", dt.date(1990, 1, 1), "z@x.y", "1", 10, 9)])
    monkeypatch.undo()
    load(spark, root, 1, sale)
    assert [r.description for r in batch.published(spark, root, "sales_fact").collect()] == ["a"]
    assert [r.department_id for r in batch.published(spark, root, "employee_dim").collect()] == [1]
    load(spark, root, 2, [(dt.datetime(2024, 1, 2), 2, 1, "b", 1.0, 1)], cities=[(1, "c", "s", "ab", "Y")])
    assert [(r.city_id, r.country) for r in batch.published(spark, root, "city_dim").collect()] == [(1, "Y")]


def test_same_day_transfer_leaves_one_current_row(spark):
    root = scratch_path(spark, "t-transfer")
    d = dt.date(1990, 1, 1)
    load(spark, root, 1, [(dt.datetime(2024, 1, 1), 1, 1, "a", 1.0, 1)], people=[("A", "a", "t", d, "a@x.y", "1", 10, 1)], natural_key=["email"])
    load(spark, root, 1, [(dt.datetime(2024, 1, 2), 2, 1, "b", 1.0, 1)], people=[("A", "a", "t", d, "a@x.y", "1", 10, 2)], natural_key=["email"])
    dim = batch.published(spark, root, "employee_dim").collect()
    assert [(r.department_id, r.is_current) for r in dim] == [(2, True)]


def test_every_assigned_employee_has_a_key(spark):
    root = scratch_path(spark, "t-people")
    d = dt.date(1990, 1, 1)
    people = [("A", "a", "t", d, "a@x.y", "1", 10, 1), ("A", "a", "t", d, "a@x.y", "2", 11, 2), ("B", "b", "t", d, "b@x.y", "3", 10, 1)]
    load(spark, root, 1, [(dt.datetime(2024, 1, 1), i, 1, "s", 1.0, 1) for i in range(50)], people=people, natural_key=["email"])
    ids = {r.emp_id for r in batch.published(spark, root, "key_map").collect()}
    assert {r.emp_id for r in batch.published(spark, root, "sales_fact").collect()} == ids == {1, 2}


def test_lookup_is_narrow_and_touched_read_lists_these_partitions(spark):
    from starloom.plans.queries import _scd1_side

    root = scratch_path(spark, "t-prune")
    day = lambda m: dt.datetime(2024, m, 1)
    first = [(day(m), 100 * m + i, 1, "a", 1.0, 1) for m in range(1, 11) for i in range(3)]
    publish.upsert_batch(spark, root, _scd1_side(spark.createDataFrame(first, SALES)))
    run_ = Store(spark, root).begin()
    keys = run_.work(spark.createDataFrame([(day(3), 301, 1, "b", 1.0, 1), (day(4), 400, 1, "b", 1.0, 1)], SALES), "keys")
    known = publish.known_rows(run_, "sales_fact", keys, "trx_id", ["record_hash", "year", "month"])
    assert known.count() == 2
    read = [line for line in known._jdf.queryExecution().simpleString().split("\n") if "year" in line and "FileScan" in line]
    assert len(read) == 1 and "trx_id" in read[0] and "record_hash" in read[0] and "amount" not in read[0]
    publish.upsert_batch(spark, root, _scd1_side(spark.createDataFrame([(day(3), 301, 1, "b", 1.0, 1)], SALES)))
    files = Store(spark, root).read("sales_fact").inputFiles()
    assert {f.split("/month=")[1].split("/")[0] for f in files if "version=00000002" in f} == {"3"}
    assert not [f for f in files if "version=00000001" in f and "/month=3/" in f]


def test_every_sale_is_in_one_of_two_loads(spark):
    """Nothing of the input is left out, and the second load reaches what the first lacks."""
    everything = fx.sales(spark, SF)
    for inputs, lookback in ((fx.batch_inputs, 365), (fx.late_inputs, 730)):
        one, two = (inputs(spark, SF, n)[1] for n in (1, 2))
        mark = one.agg(F.max("transacted_at")).first()[0]
        reached = two.filter(F.col("transacted_at").isNull() | (F.col("transacted_at") > F.lit(mark - dt.timedelta(days=lookback))))
        assert everything.join(one.unionByName(reached), "trx_id", "left_anti").count() == 0
        assert one.count() and two.count()


def test_audit_keeps_line_breaks(spark):
    root = scratch_path(spark, "t-breaks")
    d = dt.date(1990, 1, 1)
    odd = 'A\n"B", \\ \r'
    people = [(odd, "", "t", d, None, "1", 10, 1), ("X", "x", "t", d, "a@x.y", "1", 10, 1)]
    out = load(spark, root, 1, [(dt.datetime(2024, 1, 1), 1, 1, "a", 1.0, 1)], people=people)
    audit = batch.published(spark, root, "audit").collect()
    assert out.metrics["bad_rows"] == 1 and [(r.first_name, r.last_name, r.reasons) for r in audit] == [(odd, "", "email_null")]


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_null_partitions_and_output_format(spark, fmt):
    root = scratch_path(spark, f"t-fmt-{fmt}")
    load(spark, root, 1, [(dt.datetime(2024, 1, 1), 1, 1, "a", 1.0, 1), (None, 2, 1, "undated", 1.0, 1)], fmt=fmt)
    load(spark, root, 2, [(dt.datetime(2024, 2, 1), 3, 1, "c", 1.0, 1), (None, 2, 1, "changed", 1.0, 1)], fmt=fmt)
    fact = sorted((r.trx_id, r.description, r.month) for r in batch.published(spark, root, "sales_fact").collect())
    assert fact == [(1, "a", 1), (2, "changed", None), (3, "c", 2)]


def test_files_with_corrupt_lines(spark):
    root = scratch_path(spark, "t-files")
    paths = fx.csv_inputs(spark, SF, f"{root}/in")
    out = batch.run_batch_from(spark, paths, f"{root}/out", fx.AS_OF, fmt="csv")
    m = out.metrics
    employees = fx.employees(spark, SF)
    assert m["input_rows"] == employees.count() == m["valid_rows"] + m["bad_rows"]
    assert m["corrupt_employees"] == employees.filter("phone = '5557'").count() > 0 and m["corrupt_sales"] > 0
    assert m["fact_rows"] == fx.sales(spark, SF).count()
    lines = batch.published(spark, f"{root}/out", "corrupt_lines")
    assert lines.filter("input = 'sales' AND corrupt_record LIKE '%,n/a,%'").count() == m["corrupt_sales"]


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/New_York"])
def test_marks_do_not_depend_on_the_drivers_zone(zone, tmp_path):
    """Timestamps with a zone, the driver in another zone than the session: load, skip, load."""
    import os
    import subprocess
    import sys

    code = f"""
import datetime as dt, sys
sys.path.insert(0, {os.getcwd()!r})
from starloom.session import local_session
from starloom.plans import batch
from starloom.plans.store import Store
spark = local_session(cores=2, shuffle_partitions=2)
day = dt.date(1990, 1, 1)
emp = spark.createDataFrame([("A", "a", "t", day, "a@x.y", "1", 10, 1)], "first_name string, last_name string, job_title string, dob date, email string, phone string, salary int, department_id int")
city = spark.createDataFrame([(1, "c", "s", "ab", "X")], "city_id int, city string, state string, state_abv string, country string")
seen = []
for n, hour in enumerate([12, 12, 14]):
    sales = spark.sql(f"select timestamp'2024-01-05 {{hour}}:00:00' as transacted_at, {{n + 1}} as trx_id, 1 as retailer_id, 'x' as description, 1.0D as amount, 1 as city_id")
    seen.append(batch.run_batch(spark, emp, sales, city, {str(tmp_path)!r}, dt.date(2024, 1, 6)).decision)
marks = [str(r[0]) for r in Store(spark, {str(tmp_path)!r}).control().orderBy("seq").select("mark_value").collect()]
print("SEEN", seen, marks)
"""
    done = subprocess.run([sys.executable, "-c", code], env=os.environ | {"TZ": zone}, capture_output=True, text=True, timeout=300)
    assert "SEEN ['first_load', 'skip', 'incremental'] ['2024-01-05 12:00:00', '2024-01-05 14:00:00']" in done.stdout, done.stdout + done.stderr[-2000:]
