"""Slowly-changing-dimension merges (T9, T10, T12), each planned as ONE join.

Type 1 (``merge_scd1``), key ``trx_id``:

    staging  target             result                                      change_type
    present  absent             staging row                                 insert
    present  present, hash !=   target row, update columns from staging     update
    present  present, hash ==   target row                                  unchanged
    absent   present            target row                                  retained

Columns outside ``update_columns`` (transacted_at, year, month) never change on update, so an
update never moves a row to another partition. Null keys are rejected by default (a replay
would insert them again); several staging rows per key keep the latest ``transacted_at``, then
the greatest ``record_hash``. Deduplication is a sort aggregate on the key (whole rows are compared);
the full outer join reuses its shuffle and the order of its output. Stored rows with a null key, which
``null_key="insert"`` creates, match nothing and are retained: a side is present if its marker column
is, whatever its key.

Type 2 (``merge_scd2``), key ``emp_id``, validity ``[effective_start_date, effective_end_date)``:
a full outer join of the staging rows with the *current* target rows; every joined row yields
one or two versions through ``explode(filter(array(old, new), not null))``; the closed history
is appended without a join. A second change on the same ``as_of`` replaces that day's version
instead of leaving an empty interval ``[d, d)``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import date_lit
from starloom.schemas import SALES_UPDATE_COLUMNS

INSERT, UPDATE, UNCHANGED, RETAINED = "insert", "update", "unchanged", "retained"


def latest_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order`` (a struct compare, nulls smallest).

    The grouping column itself is returned as the key, so a following join on ``key`` reuses
    this aggregate's hash partitioning and ordering instead of shuffling again.
    """
    others = [c for c in df.columns if c != key]
    return (
        df.groupBy(key)
        .agg(F.max_by(F.struct(*others), F.struct(*[F.col(c) for c in order])).alias("__r"))
        .select(*[F.col(key) if c == key else F.col(f"__r.{c}").alias(c) for c in df.columns])
    )


@dataclass
class Scd1Result:
    merged: DataFrame  # target columns + change_type
    rejected: DataFrame  # staging rows with a null key (empty when null_key="insert")


def _present(src: DataFrame, target: DataFrame, key: str, how: str) -> tuple[DataFrame, Column, Column]:
    """The join of both sides, and whether a row has a staging and a target side."""
    s, t = src.withColumn("__s", F.lit(True)), target.withColumn("__t", F.lit(True))
    joined = s.alias("s").join(t.alias("t"), F.col(f"s.{key}") == F.col(f"t.{key}"), how)
    return joined, F.col("s.__s").isNotNull(), F.col("t.__t").isNotNull()


def _classified(src: DataFrame, target: DataFrame, key: str, hash_col: str, how: str) -> tuple[DataFrame, Column]:
    joined, in_src, in_target = _present(src, target, key, how)
    change = (
        F.when(~in_target, F.lit(INSERT))
        .when(~in_src, F.lit(RETAINED))
        .when(F.col(f"s.{hash_col}") == F.col(f"t.{hash_col}"), F.lit(UNCHANGED))
        .otherwise(F.lit(UPDATE))
    )
    return joined, change


def _prepare_staging(staging: DataFrame, key: str, dedup_order: Sequence[str], null_key: str, on_duplicate: str):
    if null_key not in ("reject", "insert"):
        raise ValueError("null_key must be 'reject' or 'insert'")
    if on_duplicate not in ("latest", "error", "unique"):
        raise ValueError("on_duplicate must be 'latest', 'error' or 'unique' (already one row per key)")
    keyed = staging.filter(F.col(key).isNotNull())
    nulls = staging.filter(F.col(key).isNull())
    if on_duplicate == "latest":
        keyed = latest_per_key(keyed, key, [c for c in dedup_order if c in staging.columns])
    elif on_duplicate == "error":
        repeated = keyed.groupBy(key).count().filter("count > 1").limit(1).count()
        if repeated:
            raise ValueError(f"staging holds repeated values of {key}")
    return keyed, nulls


def merge_scd1(
    staging: DataFrame,
    target: DataFrame,
    key: str = "trx_id",
    update_columns: Sequence[str] = SALES_UPDATE_COLUMNS,
    hash_col: str = "record_hash",
    dedup_order: Sequence[str] = ("transacted_at", "record_hash"),
    null_key: str = "reject",
    on_duplicate: str = "latest",
) -> Scd1Result:
    """Type 1 upsert of ``staging`` into ``target`` by ``key`` (see the module table)."""
    src, nulls = _prepare_staging(staging, key, dedup_order, null_key, on_duplicate)
    joined, change = _classified(src, target, key, hash_col, "full_outer")
    take_src_all = change == INSERT
    take_src_update = change.isin(INSERT, UPDATE)
    out_cols = []
    for c in target.columns:
        s_c = F.col(f"s.{c}") if c in src.columns else F.lit(None)
        pick = take_src_update if c in update_columns else take_src_all
        out_cols.append(F.when(pick, s_c).otherwise(F.col(f"t.{c}")).cast(target.schema[c].dataType).alias(c))
    merged = joined.select(*out_cols, change.alias("change_type"))
    if null_key == "insert":
        inserted = nulls.select(
            *[(F.col(c) if c in nulls.columns else F.lit(None)).cast(target.schema[c].dataType).alias(c) for c in target.columns],
            F.lit(INSERT).alias("change_type"),
        )
        merged = merged.unionByName(inserted)
        nulls = nulls.limit(0)
    return Scd1Result(merged=merged, rejected=nulls)


def merge_scd1_snapshot(
    staging: DataFrame,
    target: DataFrame,
    key: str = "trx_id",
    hash_col: str = "record_hash",
    dedup_order: Sequence[str] = ("transacted_at", "record_hash"),
) -> DataFrame:
    """The staging rows classified against the target; target-only rows are not returned.

    This is the literal result of the three-branch form (unchanged, updated and new rows, all
    with staging values), computed with one left outer join instead of three joins.
    """
    src, nulls = _prepare_staging(staging, key, dedup_order, "insert", "latest")
    tgt = target.select(key, hash_col)
    joined, change = _classified(src, tgt, key, hash_col, "left")
    classified = joined.select(*[F.col(f"s.{c}").alias(c) for c in src.columns], change.alias("change_type"))
    return classified.unionByName(nulls.withColumn("change_type", F.lit(INSERT)))


# ---------------------------------------------------------------- type 2

NEW, CHANGED, EXPIRED, SAME, KEPT, HISTORY = "new", "new_version", "expired", "unchanged", "retained", "history"


def merge_scd2(
    staging: DataFrame,
    target: DataFrame,
    as_of: dt.date | str,
    key: str = "emp_id",
    hash_col: str = "record_hash",
    start_col: str = "effective_start_date",
    end_col: str = "effective_end_date",
    current_col: str = "is_current",
) -> DataFrame:
    """Type 2 merge; returns the full dimension (target columns + ``change_type``)."""
    scd_cols = [start_col, end_col, current_col]
    attrs = [c for c in target.columns if c not in scd_cols]
    schema = target.schema
    is_current = F.coalesce(F.col(current_col), F.lit(False))
    history = target.filter(~is_current)
    current = target.filter(is_current)
    src = latest_per_key(staging.filter(F.col(key).isNotNull()), key, [hash_col])
    joined, in_src, in_target = _present(src, current, key, "full_outer")
    both = in_src & in_target
    changed = both & (F.col(f"s.{hash_col}") != F.col(f"t.{hash_col}"))
    same_day = changed & (F.col(f"t.{start_col}") == date_lit(as_of))

    def version(side: str, start: Column, end: Column, cur: Column, tag: str) -> Column:
        fields = [F.col(f"{side}.{c}").cast(schema[c].dataType).alias(c) for c in attrs]
        fields += [
            start.cast("date").alias(start_col),
            end.cast("date").alias(end_col),
            cur.alias(current_col),
            F.lit(tag).alias("change_type"),
        ]
        return F.struct(*fields)

    t_start, t_end = F.col(f"t.{start_col}"), F.col(f"t.{end_col}")
    old = (
        F.when(~in_src, version("t", t_start, t_end, F.lit(True), KEPT))
        .when(both & ~changed, version("t", t_start, t_end, F.lit(True), SAME))
        .when(changed & ~same_day, version("t", t_start, date_lit(as_of), F.lit(False), EXPIRED))
    )
    new = F.when(
        ~in_target | changed,
        version("s", date_lit(as_of), F.lit(None), F.lit(True), F.when(~in_target, F.lit(NEW)).otherwise(F.lit(CHANGED))),
    )
    versions = joined.select(F.explode(F.filter(F.array(old, new), lambda v: v.isNotNull())).alias("v")).select("v.*")
    return history.select(*target.columns, F.lit(HISTORY).alias("change_type")).unionByName(versions)
