import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.operators import control, facts
from starloom.plans.store import Store
from starloom.session import scratch_path
from starloom.sources.io import WriteMode, read_if_exists, read_table, write_table
from tests.conftest import rows

CTL = "mark_key string, mark_value timestamp_ntz, seq bigint"
M = dt.datetime(2024, 1, 31, 23, 59, 59)


def batch(spark, ts):
    return facts.batch_max(spark.createDataFrame([(t,) for t in ts], "transacted_at timestamp_ntz"))


@pytest.mark.parametrize(
    "marks,ts,expected",
    [
        ([], [M], "first_load"),
        ([("last_Processed_date", M, 1)], [M], "skip"),  # equal: nothing new
        ([("last_Processed_date", M, 1)], [M + dt.timedelta(seconds=1)], "incremental"),
        ([("last_Processed_date", M, 1)], [M - dt.timedelta(days=1)], "skip"),
        ([("last_Processed_date", M, 1)], [], "skip"),  # empty batch
        ([("other", M, 1)], [M], "first_load"),  # unknown key = no mark
    ],
)
def test_decision(spark, marks, ts, expected):
    ctl = spark.createDataFrame(marks, CTL) if marks else None
    assert control.decide(batch(spark, ts), ctl).first()["decision"] == expected


def test_latest_mark_wins(spark):
    ctl = spark.createDataFrame([("k", M, 1), ("k", M - dt.timedelta(days=9), 2), ("j", M, 1)], CTL)
    assert dict(rows(control.latest_marks(ctl), "mark_key", "mark_value")) == {"j": M, "k": M - dt.timedelta(days=9)}


def test_lookback_moves_the_gate(spark):
    ctl = spark.createDataFrame([("last_Processed_date", M, 1)], CTL)
    late = batch(spark, [M - dt.timedelta(days=3)])
    assert control.decide(late, ctl, lookback="7 days").first()["decision"] == "incremental"
    assert control.decide(late, ctl, lookback="1 day").first()["decision"] == "skip"


def test_commits_append(spark):
    root = scratch_path(spark, "control-test")
    assert Store(spark, root).control() is None
    for n in range(2):
        mark = spark.createDataFrame([(M + dt.timedelta(days=n),)], "mark_value timestamp_ntz")
        Store(spark, root).begin().commit("k", mark)
    ctl = Store(spark, root).control()
    assert rows(ctl, "seq") == [(1,), (2,)]
    assert control.latest_marks(ctl).first()["mark_value"] == M + dt.timedelta(days=1)


def test_store_replace_append_rewrite(spark):
    root = scratch_path(spark, "store")
    table = lambda data: spark.createDataFrame(data, "k int, p string")
    run = Store(spark, root).begin()
    run.replace("t", table([(1, "a"), (2, "b"), (3, None)]), ["p"])
    run.append("log", table([(1, "x")]))
    assert not Store(spark, root).has("t")  # nothing is visible before the commit
    run.commit("k")
    store = Store(spark, root)
    run = store.begin()
    touched = spark.createDataFrame([("b",), (None,), ("c",)], "p string")
    run.rewrite("t", table([(9, "c"), (4, None)]), touched, ["p"])  # b is emptied
    run.append("log", table([(2, "y")]))
    run.append("log2", table([]))
    assert rows(store.read("t"), "k") == [(1,), (2,), (3,)]
    run.commit("k")
    store = Store(spark, root)
    assert rows(store.read("t")) == rows(table([(1, "a"), (9, "c"), (4, None)]))
    assert rows(store.read("log"), "k") == [(1,), (2,)] and store.read("log2").count() == 0
    assert rows(store.map_of("t"), "p", "__rows") == [("a", 1), ("c", 1), (None, 1)]
    run = store.begin()
    run.replace("t", table([]), ["p"])
    run.commit("k")
    assert Store(spark, root).read("t").count() == 0
    assert rows(Store(spark, root).read("log"), "k") == [(1,), (2,)]


def test_only_live_folders_are_read(spark):
    """No file of an older version of a partition is in the scan; odd partition values find their folders."""
    root = scratch_path(spark, "live")
    table = lambda data: spark.createDataFrame(data, "k int, p string")
    odd = ["a b", "50%", "x=y/z", "+", "é", "[1]", "{q}", "a:b", None]
    run = Store(spark, root).begin()
    run.replace("t", table(list(enumerate(odd))), ["p"])
    run.commit("k")
    assert rows(Store(spark, root).read("t")) == rows(table(list(enumerate(odd))))
    for n in range(3):
        run = Store(spark, root).begin()
        run.rewrite("t", table([(100 + n, "50%")]), spark.createDataFrame([("50%",)], "p string"), ["p"])
        run.commit("k")
    store = Store(spark, root)
    files = store.read("t").inputFiles()
    assert len([f for f in files if "version=00000001" in f]) == len(odd) - 1
    assert len([f for f in files if "version=00000004" in f]) == 1 and len(files) == len(odd)
    assert rows(store.read("t").filter("p = '50%'"), "k") == [(102,)]
    one = store.map_of("t").filter("p = '+'")
    assert store.read("t", within=one).inputFiles() == [f for f in files if "p=+" in f]


def test_slice_keeps_undated_rows(spark):
    sales = spark.createDataFrame([(M,), (M + dt.timedelta(hours=1),), (None,)], "transacted_at timestamp_ntz")
    assert control.incremental_slice(sales, F.lit(M).cast("timestamp_ntz")).count() == 2
    assert control.incremental_slice(sales, F.lit(M).cast("timestamp_ntz"), "1 day").count() == 3


def test_write_modes_and_formats(spark):
    from pyspark.errors import AnalysisException

    df = spark.createDataFrame([(1, "a", 2024), (2, None, 2025)], "id int, s string, year int")
    for fmt in ("csv", "json", "parquet"):
        path = scratch_path(spark, f"io-{fmt}")
        write_table(df, path, fmt=fmt, partition_by=None)  # partitionBy None is skipped
        assert rows(read_table(spark, path, fmt=fmt, schema=df.schema)) == rows(df)
        write_table(df, path, fmt=fmt, mode=WriteMode.APPEND)
        assert read_table(spark, path, fmt=fmt, schema=df.schema).count() == 4
        write_table(df, path, fmt=fmt, mode=WriteMode.IGNORE)
        assert read_table(spark, path, fmt=fmt, schema=df.schema).count() == 4
        with pytest.raises(AnalysisException):
            write_table(df, path, fmt=fmt, mode=WriteMode.ERROR_IF_EXISTS)


def test_dynamic_overwrite_keeps_other_partitions(spark):
    path = scratch_path(spark, "dyn")
    df = spark.createDataFrame([(1, 2024), (2, 2025)], "id int, year int")
    write_table(df, path, partition_by="year")
    write_table(spark.createDataFrame([(3, 2025)], "id int, year int"), path, partition_by="year")
    assert rows(read_table(spark, path), "id", "year") == [(1, 2024), (3, 2025)]


def test_corrupt_csv_lines_are_kept(spark, tmp_path_factory):
    path = scratch_path(spark, "corrupt")
    spark.createDataFrame([("1,a",), ("x,b",)], "value string").write.text(path)
    df = read_table(spark, path, fmt="csv", schema="id int, s string", corrupt_column="_corrupt", options={"header": False})
    got = rows(df, "id", "_corrupt")
    assert got == [(1, None), (None, "x,b")]


VALUES = ["a\nb", "a\rb", "a\r\nb", 'q"x"', "back\\slash", "\\", 'x\\"y', "a,b", "", None, " lead ", '"', '""', "\n", "\r", "#c", "\\N", "é\u2028z", "tab\t"]


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_any_value_survives_a_file(spark, fmt):
    path = scratch_path(spark, f"values-{fmt}")
    df = spark.createDataFrame([(i, v, v if i % 2 else "z") for i, v in enumerate(VALUES)], "i int, v string, w string")
    write_table(df, path, fmt=fmt)
    back = read_table(spark, path, fmt=fmt, schema=df.schema, corrupt_column="bad" if fmt != "parquet" else None)
    assert rows(back, *df.columns) == rows(df)
    if fmt != "parquet":
        assert {r.bad for r in back.collect()} == {None}


def test_delta_reports_missing_connector(spark):
    with pytest.raises(RuntimeError, match="Delta"):
        read_table(spark, scratch_path(spark, "delta"), fmt="delta")


def test_read_if_exists(spark):
    assert read_if_exists(spark, scratch_path(spark, "missing")) is None
