"""Sales fact operators: city enrichment (T1), employee assignment (T4), batch maximum (T6, C6),
calendar columns (T7) and staging hashes (T8, T11).
"""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import date_lit, end_of_day
from starloom.functions.hashing import record_hash, strict_hash
from starloom.schemas import EMPLOYEE_HASH_COLUMNS, SALES_HASH_COLUMNS

JOIN_TYPES = ("inner", "left", "left_anti")


def enrich_with_city(sales: DataFrame, cities: DataFrame, how: str = "inner", key: str = "city_id") -> DataFrame:
    """Sales joined to the city dimension on one ``city_id`` column.

    ``inner`` drops sales without a city (and null keys), ``left`` keeps them with null city
    columns, ``left_anti`` returns only those orphans. The dimension is small, but its size is
    left to Spark's size-checked join selection (static estimate, then AQE on measured size)
    instead of an unconditional broadcast hint.
    """
    if how not in JOIN_TYPES:
        raise ValueError(f"how must be one of {JOIN_TYPES}")
    return sales.join(cities, on=key, how=how)


def employee_count(employees: DataFrame) -> Column:
    """Number of employees as a scalar subquery: evaluated once, no join, no driver round trip."""
    return employees.select(F.count(F.lit(1))).scalar()


def assign_employee(sales: DataFrame, employees: DataFrame, key: str = "trx_id", out: str = "emp_id") -> DataFrame:
    """T4: ``emp_id = abs(hash(key)) % N + 1`` with N = number of employees.

    ``hash`` is Spark's Murmur3 (seed 42) of the key in its declared type. The hash is widened to
    bigint before ``abs`` (abs of -2^31 overflows an int), and N = 0 gives a null id instead of a
    division by zero.
    """
    n = F.nullif(employee_count(employees), F.lit(0))  # one subquery; 0 -> null -> null id
    emp = F.abs(F.hash(F.col(key)).cast("bigint")) % n + F.lit(1)
    return sales.withColumn(out, emp.cast("bigint"))


def add_year_month(df: DataFrame, ts_col: str = "transacted_at") -> DataFrame:
    """Integer year and month of the calendar date of ``ts_col``."""
    d = F.to_date(F.col(ts_col))
    return df.withColumn("year", F.year(d)).withColumn("month", F.month(d))


def batch_max(sales: DataFrame, ts_col: str = "transacted_at") -> DataFrame:
    """One row with the greatest timestamp, its date and the end of that day.

    ``max_ts`` is the exact high-water mark; ``day_mark`` (last microsecond of the greatest date)
    is the day-granularity value. Empty input gives one row of nulls.
    """
    return sales.agg(F.max(ts_col).alias("max_ts")).select(
        "max_ts",
        F.to_date("max_ts").alias("max_date"),
        end_of_day(F.to_date("max_ts")).alias("day_mark"),
    )


def sales_staging(sales: DataFrame, strict: bool = False, columns: Sequence[str] = SALES_HASH_COLUMNS) -> DataFrame:
    """``record_hash`` over retailer_id, description, amount, city_id, emp_id."""
    out = sales.withColumn("record_hash", record_hash(columns))
    if strict:
        out = out.withColumn("strict_hash", strict_hash(columns))
    return out


def employee_staging(
    employees: DataFrame,
    as_of: dt.date | str,
    strict: bool = False,
    columns: Sequence[str] = EMPLOYEE_HASH_COLUMNS,
) -> DataFrame:
    """Row hash plus an open validity interval starting at ``as_of``."""
    out = employees.withColumn("record_hash", record_hash(columns))
    if strict:
        out = out.withColumn("strict_hash", strict_hash(columns))
    return (
        out.withColumn("effective_start_date", date_lit(as_of))
        .withColumn("effective_end_date", F.lit(None).cast("date"))
        .withColumn("is_current", F.lit(True))
    )
