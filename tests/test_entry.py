import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "orders"]
# queries whose oracle check is cheap enough for the unit suite (the full set runs in tools/check_oracle.py)
QUICK = [
    "valid_employees",
    "bad_employee_audit",
    "employee_dim_ids",
    "sales_fact_assigned",
    "sales_staging",
    "scd1_merge",
    "scd2_merge",
    "batch_decision",
]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == entry.entry(spark).columns


def test_every_warehouse_query_has_an_oracle():
    assert set(entry.queries()) - set(entry.LLM_QUERIES) == set(entry.oracle_sql()) - set(entry.LLM_SQL)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_oracle(spark, duck, name):
    from tools.check_oracle import _rows

    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)
