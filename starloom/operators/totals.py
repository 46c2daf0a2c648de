"""Totals over several groupings at once (cube, rollup, grouping sets)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CUBE, ROLLUP = "cube", "rollup"


def grouped_totals(df: DataFrame, columns: Sequence[str], value: Column, sets: str | Sequence[Sequence[str]] = CUBE) -> DataFrame:
    """``columns, grouping, n, total``: rows and sum of ``value`` for every grouping in ``sets``.

    ``grouping`` has a bit per column, the first the highest, that is set if the row is a total over that column; so a
    total is told apart from the group of a null. Rows are added up by all columns first, and only these sums are
    repeated for the groupings: the expansion grows with the groups, not with the rows, and a hot group is one
    row per task before any shuffle. Give ``value`` as a decimal for sums that do not depend on the order.
    Edge cases: a null value counts as a row and adds nothing. An empty table has no groups but the grand
    total of a cube or rollup, which SQL leaves out as well when there are grouping columns.
    """
    fine = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"), F.sum(value).alias("__v"))
    if sets == CUBE:
        grouped = fine.cube(*columns)
    elif sets == ROLLUP:
        grouped = fine.rollup(*columns)
    else:
        grouped = fine.groupingSets([[F.col(c) for c in s] for s in sets], *columns)
    return grouped.agg(F.grouping_id().cast("bigint").alias("grouping"), F.sum("__n").alias("n"), F.sum("__v").alias("total"))
