"""Dimensions: city (T2), date (T5) and stable employee surrogate keys.

* ``city_dim``: one row per city_id; the survivor is the smallest row by the remaining columns,
  taken with ``min(struct(...))``: a partial (sort) aggregate before the shuffle, so a repeated key
  sends one row per map task.
* ``date_dim``: distinct calendar dates of the sales, null dates dropped, optionally merged with
  the stored dates so that an incremental batch never loses earlier days.
* ``assign_keys``: dense ids ordered by the natural key, without a single-partition window; ids
  are kept in a key map so a natural key keeps its id across runs and new keys continue after
  the greatest stored id.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.ranking import distributed_row_number


def city_dim(cities: DataFrame, key: str = "city_id") -> DataFrame:
    """One row per ``key``, deterministic survivor (smallest remaining columns, nulls first)."""
    others = [c for c in cities.columns if c != key]
    return (
        cities.groupBy(key)
        .agg(F.min(F.struct(*others)).alias("__r"))
        .select(key, *[F.col(f"__r.{c}").alias(c) for c in others])
    )


def date_dim(sales: DataFrame, ts_col: str = "transacted_at", stored: DataFrame | None = None) -> DataFrame:
    """T5: date, day, month, year, quarter for every date with a sale (and every stored date)."""
    dates = sales.select(F.to_date(ts_col).alias("date")).where(F.col("date").isNotNull())
    if stored is not None:
        dates = dates.unionByName(stored.select("date"))
    return (
        dates.distinct()
        .select(
            "date",
            F.dayofmonth("date").alias("day"),
            F.month("date").alias("month"),
            F.year("date").alias("year"),
            F.quarter("date").alias("quarter"),
        )
    )


def _null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k])
        cond = c if cond is None else cond & c
    return cond


@dataclass
class KeyAssignment:
    rows: DataFrame  # input rows with the id column
    new_keys: DataFrame  # key map rows created by this run (append them to the stored map)


def assign_keys(
    df: DataFrame,
    keys: Sequence[str],
    key_map: DataFrame | None = None,
    id_col: str = "emp_id",
    keys_unique: bool = False,
) -> KeyAssignment:
    """Dense ids ordered by ``keys`` (ascending, nulls first), stable across runs.

    Without a stored map the ids are 1..N in key order, equal to
    ``row_number() over (order by keys)``. With a map, known keys keep their id and new keys
    get ``max(id) + row_number() over (order by keys)``. Keys match null-safely.
    ``keys_unique=True`` (one row per key, as after deduplication) numbers the rows directly on a
    first run, without the distinct pass and the join back.
    """
    keys = list(keys)
    if key_map is None and keys_unique:
        rows = distributed_row_number(df, [], keys, out=id_col)
        rows = rows.select(id_col, *df.columns)
        return KeyAssignment(rows=rows, new_keys=rows.select(*keys, id_col))
    distinct_keys = df.select(*keys).distinct()
    if key_map is None:
        fresh = distinct_keys
        offset = F.lit(0).cast("bigint")
    else:
        stored = key_map.select(*keys, id_col)
        fresh = distinct_keys.join(stored, _null_safe_on(distinct_keys, stored, keys), "left_anti")
        offset = F.coalesce(stored.select(F.max(id_col)).scalar(), F.lit(0)).cast("bigint")
    numbered = distributed_row_number(fresh, [], keys, out="__seq")
    new_keys = numbered.select(*keys, (F.col("__seq") + offset).alias(id_col))
    mapping = new_keys if key_map is None else key_map.select(*keys, id_col).unionByName(new_keys)
    return KeyAssignment(rows=attach_keys(df, mapping, keys, id_col), new_keys=new_keys)


def attach_keys(df: DataFrame, key_map: DataFrame, keys: Sequence[str], id_col: str = "emp_id") -> DataFrame:
    """Rows of ``df`` with their id from ``key_map`` (null-safe match on ``keys``)."""
    mapping = key_map.select(*[F.col(k).alias(f"__m_{k}") for k in keys], id_col)
    cond = None
    for k in keys:
        c = df[k].eqNullSafe(mapping[f"__m_{k}"])
        cond = c if cond is None else cond & c
    rows = df.join(mapping, cond, "inner").drop(*[f"__m_{k}" for k in keys])
    return rows.select(id_col, *df.columns)
