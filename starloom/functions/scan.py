"""Running aggregates in an order, without sending a whole group to one task.

``sum(v) over (partition by k order by o rows between unbounded preceding and current row)``, and the same with
``first`` and ``last`` of the non-null values, moves every row of a key to one task. ``running`` computes the
same numbers from range partitions (``ranking.range_numbered``):

1. the rows are range-partitioned on (key, order) and numbered, so a hot key spans several partitions;
2. a window inside each (partition, key) aggregates from the partition's start;
3. only the first key of a partition can go on from the one before. The aggregates of each partition's last
   key, one row per partition, are combined along the partitions; what has come in that way so far is
   broadcast (at most one row per range partition) and joined to the rows of the first keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.ranking import range_numbered

SUM, FIRST, LAST = "sum", "first", "last"

_POS, _PID = "__pos", "__pid"


@dataclass(frozen=True)
class Running:
    """The running ``kind`` (sum, or first or last non-null) of ``value``."""

    kind: str
    value: Column

    def over(self, column: Column, window=None) -> Column:
        made = {SUM: lambda c: F.sum(c), FIRST: lambda c: F.first(c, ignorenulls=True), LAST: lambda c: F.last(c, ignorenulls=True)}[self.kind](column)
        return made if window is None else made.over(window)

    def joined(self, before: Column, here: Column) -> Column:
        if self.kind == SUM:
            return F.when(before.isNull(), here).when(here.isNull(), before).otherwise(before + here)
        return F.coalesce(before, here) if self.kind == FIRST else F.coalesce(here, before)


def running(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column], columns: dict[str, Running], num_partitions: int | None = None
) -> DataFrame:
    """``df`` with ``columns``: each aggregate of the rows of the same keys (nulls are equal) up to this one.

    Rows that tie in the order come in any order; end it with unique columns where that matters.
    """
    keys = list(keys)
    value = lambda name: f"__v_{name}"
    ranged = range_numbered(df.withColumns({value(n): r.value for n, r in columns.items()}), keys, order_by, num_partitions)
    inside = Window.partitionBy(_PID, *keys).orderBy(_POS).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = ranged.withColumns({n: r.over(F.col(value(n)), inside) for n, r in columns.items()})

    # at most one row per range partition from here on
    key = F.struct(*[F.col(k) for k in keys]) if keys else F.lit(0)
    edges = ranged.groupBy(_PID).agg(F.min_by(key, _POS).alias("__head"), F.max_by(key, _POS).alias("__tail"))
    of_tail = ranged.join(F.broadcast(edges.select(_PID, "__tail")), _PID).filter(key.eqNullSafe(F.col("__tail")))
    tails = of_tail.groupBy(_PID, F.col("__tail").alias("__key")).agg(*[_whole(r, F.col(value(n))).alias(n) for n, r in columns.items()])
    so_far = Window.partitionBy("__key").orderBy(_PID).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tails = tails.withColumns({n: r.over(F.col(n), so_far) for n, r in columns.items()})
    one_on = Window.partitionBy(F.lit(0)).orderBy(_PID)
    came = edges.select(_PID, "__head").join(tails, _PID).select(
        _PID, "__head", F.lag("__key").over(one_on).alias("__from"), *[F.lag(n).over(one_on).alias(f"__c_{n}") for n in columns]
    )
    came = came.filter(F.col("__from").eqNullSafe(F.col("__head"))).drop("__from")
    joined = rows.join(F.broadcast(came), _PID, "left")
    goes_on = F.col("__head").isNotNull() & key.eqNullSafe(F.col("__head"))
    joined = joined.withColumns({n: F.when(goes_on, r.joined(F.col(f"__c_{n}"), F.col(n))).otherwise(F.col(n)) for n, r in columns.items()})
    return joined.select(*df.columns, *columns)


def _whole(r: Running, value: Column) -> Column:
    """The aggregate of a whole group; a plain aggregate's first and last go by position."""
    at = F.when(value.isNotNull(), F.col(_POS))
    return {SUM: F.sum(value), FIRST: F.min_by(value, at), LAST: F.max_by(value, at)}[r.kind]
