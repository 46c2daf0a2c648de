import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom import schemas
from starloom.operators import quality
from tests.conftest import rows

EMP_SCHEMA = "src_id int, first_name string, last_name string, job_title string, dob date, email string, phone string, salary int, department_id int"
D = dt.date(1990, 1, 1)


def emp(spark, data):
    return spark.createDataFrame(data, EMP_SCHEMA)


@pytest.fixture()
def edge(spark):
    return emp(
        spark,
        [
            (1, "A", "X", "t", D, None, "1", 10, 1),  # null e-mail
            (2, "B", "X", "t", D, "a b@c.d e", "2", 10, 1),  # passes: unanchored pattern
            (3, "C", "X", "t", D, "c@d.e", "3", 50, 1),  # tie on salary with 4, src_id decides
            (4, "D", "X", "t", D, "c@d.e", "3", 50, 1),
            (5, "E", "X", "t", D, "e@f.g", "5", None, 1),  # null salary ranks last
            (6, "F", "X", "t", D, "e@f.g", "5", 1, 1),
            (7, "G", "X", "t", D, "h@i.j", None, 5, 2),  # null phone twice: one group
            (8, "H", "X", "t", D, "h@i.j", None, 6, 2),
            (9, "I", "X", "t", D, "bad", "9", 1, 2),  # invalid and duplicate
            (10, "J", "X", "t", D, "bad", "9", 2, 2),
        ],
    )


def test_email_flag_keeps_null(spark, edge):
    flags = dict(rows(quality.flag_email(edge), "src_id", "is_valid_email"))
    assert flags[1] is None and flags[2] is True and flags[9] is False


def test_rank_ties_nulls_and_null_keys(spark, edge):
    ranks = dict(rows(quality.rank_employees(edge, tie_breakers=["src_id"]), "src_id", "row_num"))
    assert (ranks[3], ranks[4]) == (1, 2)
    assert (ranks[6], ranks[5]) == (1, 2)  # null salary last
    assert (ranks[8], ranks[7]) == (1, 2)  # null phones grouped
    assert (ranks[10], ranks[9]) == (1, 2)


def test_rank_matches_window(spark, edge):
    from pyspark.sql import Window

    w = Window.partitionBy(*schemas.EMPLOYEE_KEY).orderBy(F.col("salary").desc_nulls_last(), "src_id")
    expected = rows(edge.withColumn("row_num", F.row_number().over(w)), "src_id", "row_num")
    assert rows(quality.rank_employees(edge, tie_breakers=["src_id"]), "src_id", "row_num") == expected


def test_split_is_total_and_reasons_are_merged(spark, edge):
    split = quality.split_employees(edge, tie_breakers=["src_id"])
    valid = {r[0] for r in rows(split.valid, "src_id")}
    audit = dict((r[0], tuple(r[1])) for r in rows(split.audit, "src_id", "reasons"))
    assert valid == {2, 3, 6, 8}
    assert audit == {
        1: ("email_null",),
        4: ("duplicate",),
        5: ("duplicate",),
        7: ("duplicate",),
        9: ("email_invalid", "duplicate"),
        10: ("email_invalid",),
    }
    c = split.counts().first().asDict()
    assert c["input_rows"] == 10 and c["valid_rows"] + c["bad_rows"] == 10
    assert (c["email_null"], c["email_invalid"], c["duplicates"]) == (1, 2, 4)


def test_identical_rows_keep_one(spark):
    same = [(1, "A", "X", "t", D, "a@b.c", "1", 10, 1)] * 3
    split = quality.split_employees(emp(spark, same))
    assert split.valid.count() == 1 and split.audit.count() == 2


def test_all_outputs_come_from_one_materialised_ranking(spark, edge):
    split = quality.split_employees(edge, tie_breakers=["src_id"])
    for df in (split.valid, split.audit, split.counts()):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and plan.count("Scan ExistingRDD") == 1


def test_valid_alone_uses_a_partial_group_limit(spark, edge):
    valid = quality.valid_employees(edge, tie_breakers=["src_id"])
    assert "WindowGroupLimit" in valid._jdf.queryExecution().executedPlan().toString()
    assert rows(valid, "src_id") == rows(quality.split_employees(edge, tie_breakers=["src_id"]).valid, "src_id")


def test_split_is_total_for_any_tie_breakers(spark, edge):
    split = quality.split_employees(edge, tie_breakers=["first_name"])
    partial = quality.split_employees(edge, tie_breakers=[])
    for s in (split, partial):
        assert s.valid.count() + s.audit.count() == 10


def test_fixture_counts(spark):
    from starloom.plans import fixtures as fx

    split = quality.split_employees(fx.employees(spark, "/root/testdata/sf0.01"), tie_breakers=["src_id"])
    c = split.counts().first().asDict()
    assert (c["input_rows"], c["valid_rows"], c["bad_rows"]) == (1500, 751, 749)
    assert (c["email_null"], c["email_invalid"], c["duplicates"]) == (38, 38, 709)


def test_rules_total_split(spark):
    as_of = dt.date(2024, 6, 1)
    df = emp(
        spark,
        [
            (1, "A", "X", "t", D, "a@b.c", "1", 0, 1),  # salary 0
            (2, "A", "X", "t", D, "a@b.c", "1", None, 1),  # null salary
            (3, "A", "X", "t", None, "a@b.c", "1", 5, 1),  # null dob
            (4, "A", "X", "t", dt.date(2006, 6, 1), "a@b.c", "1", 5, 1),  # 18 on as_of
            (5, "A", "X", "t", dt.date(2006, 6, 2), "a@b.c", "1", 5, 1),  # 18 tomorrow
            (6, "A", "X", "t", D, "bad", "1", 5, 1),
        ],
    )
    split = quality.employee_rules(df, as_of)
    assert {r[0] for r in rows(split.valid, "src_id")} == {4}
    assert {r[0] for r in rows(split.bad, "src_id")} == {1, 2, 3, 5, 6}


def test_schema_check_reports_all_problems(spark, edge):
    with pytest.raises(ValueError) as err:
        quality.check_schema(edge.drop("email", "phone").withColumn("salary", F.col("salary").cast("string")), schemas.EMPLOYEES, strict_types=True)
    text = str(err.value)
    assert "email" in text and "phone" in text and "salary" in text
    assert quality.check_schema(edge, ["email", "phone"]) is edge


def test_schema_report_counts_nulls(spark, edge):
    report = {r["column_name"]: r for r in quality.schema_report(edge, schemas.EMPLOYEES, "employees").collect()}
    assert report["email"]["null_count"] == 1 and report["email"]["nullability_ok"] is True
    assert report["phone"]["null_count"] == 2


def test_clean(spark):
    df = emp(spark, [(1, " Ann ", " Lee ", "t", D, "  U2@EX.COM ", "1", 1, 1)])
    r = quality.clean_employees(df).first()
    assert (r.first_name, r.last_name, r.email) == ("Ann", "Lee", "u2@ex.com")
