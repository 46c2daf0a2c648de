"""Date expressions: calendar parts and the age rule."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_lit(value: dt.date | str) -> Column:
    return F.lit(str(value)).cast("date")


def calendar_date(col: str | Column) -> Column:
    return F.to_date(F.col(col) if isinstance(col, str) else col)


def reached_age(dob: str | Column, years: int, as_of: dt.date | str) -> Column:
    """True when the ``years``-th birthday is on or before ``as_of``.

    ``add_months`` clamps 29 February to 28 February in a non-leap year. Null dob gives null.
    """
    birth = F.col(dob) if isinstance(dob, str) else dob
    return F.add_months(birth, 12 * years) <= date_lit(as_of)


def end_of_day(date_col: Column) -> Column:
    """Last microsecond of the day, as timestamp_ntz (the day-granularity high-water mark)."""
    return F.make_timestamp_ntz(
        F.year(date_col), F.month(date_col), F.dayofmonth(date_col), F.lit(23), F.lit(59), F.lit(59.999999).cast("decimal(8,6)")
    )
