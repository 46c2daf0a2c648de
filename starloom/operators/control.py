"""High-water mark and batch decision.

The control table is append-only; a run appends one row after everything else is written, and the row
with the greatest ``seq`` of a key is its stored mark. ``plans.store`` keeps it together with the
versions that the run publishes.

A mark is a wall clock without zone (``timestamp_ntz``). Source timestamps with a zone are cast in the
session's zone, inside Spark; no mark passes through a Python datetime on its way from the maximum to
the control table, so the zone of the driver's operating system plays no role.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIRST_LOAD, INCREMENTAL, SKIP = "first_load", "incremental", "skip"

# Fixed value: key under which the sales high-water mark is stored.
SALES_MARK_KEY = "last_Processed_date"


def latest_marks(control: DataFrame) -> DataFrame:
    """One row per key, the value with the greatest ``seq``."""
    return control.groupBy("mark_key").agg(
        F.max_by("mark_value", "seq").alias("mark_value"),
        F.max("seq").alias("seq"),
    )


def stored_mark(control: DataFrame | None, key: str = SALES_MARK_KEY, field: str = "mark_value") -> Column:
    """The latest mark of ``key`` (or its ``seq``) as a scalar subquery (null when absent)."""
    if control is None:
        return F.lit(None).cast("timestamp_ntz" if field == "mark_value" else "bigint")
    return latest_marks(control).filter(F.col("mark_key") == key).select(field).scalar()


def decide(
    batch: DataFrame, control: DataFrame | None, key: str = SALES_MARK_KEY, mark_col: str = "max_ts", lookback: str | None = None
) -> DataFrame:
    """C4: one row ``(stored_mark, batch_max, decision, stored_seq, lower)``.

    no stored mark -> first_load; batch maximum after the mark less ``lookback`` -> incremental;
    otherwise (also for an empty batch) -> skip. With ``lookback`` a delivery of late rows only is
    loaded too. ``lower`` is where an incremental slice starts. ``mark_col`` picks the batch value
    compared and stored: ``max_ts`` (exact) or ``day_mark`` (end of the greatest day).
    """
    row = batch.select(
        stored_mark(control, key).alias("stored_mark"),
        stored_mark(control, key, "seq").alias("stored_seq"),
        F.col(mark_col).cast("timestamp_ntz").alias("batch_max"),
    ).withColumn("lower", lower_bound(F.col("stored_mark"), lookback))
    return row.select(
        "stored_mark",
        "batch_max",
        F.when(F.col("batch_max").isNull(), F.lit(SKIP))
        .when(F.col("stored_mark").isNull(), F.lit(FIRST_LOAD))
        .when(F.col("batch_max") > F.col("lower"), F.lit(INCREMENTAL))
        .otherwise(F.lit(SKIP))
        .alias("decision"),
        "stored_seq",
        "lower",
    )


def lower_bound(mark: Column, lookback: str | None) -> Column:
    """The mark, moved back by ``lookback`` (an interval string such as '30 days')."""
    return mark if not lookback else mark - F.expr(f"INTERVAL {lookback}")


def incremental_slice(sales: DataFrame, mark: Column, lookback: str | None = None, ts_col: str = "transacted_at") -> DataFrame:
    """Source rows after the mark (minus ``lookback`` for late corrections), and all undated rows:
    they have no place in time, so no mark can tell that they were loaded, and loading them again
    changes nothing. ``mark`` is cast to the column's type (in the session's zone)."""
    ts = F.col(ts_col)
    return sales.filter(ts.isNull() | (ts > lower_bound(mark, lookback).cast(sales.schema[ts_col].dataType)))
