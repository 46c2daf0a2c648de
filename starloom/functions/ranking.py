"""``row_number()`` without sending a whole group (or the whole table) to one task.

``Window.partitionBy(k).orderBy(o)`` hashes every row of a key to one task, and a window
without ``partitionBy`` moves the whole table into a single partition. Both break when one key
holds a large share of the rows. ``distributed_row_number`` computes the same numbers as

    row_number() over (partition by k order by o)

as follows:

1. ``repartitionByRange(n, k, o)`` with an explicit ``n``: the range boundaries come from a
   sample, so a hot key is spread over several consecutive partitions. An explicit count keeps
   AQE from coalescing this exchange, so partition ids are stable within the job.
2. ``sortWithinPartitions(k, o)`` and ``monotonically_increasing_id()``: inside a partition the
   id grows with the order; the partition index sits in the upper bits.
3. A count per (key, partition) gives each partition's run length; a running sum over the
   partitions of a key (at most ``n`` rows per key) gives the offset of the run.
4. Join the offsets back on (key, partition). With no key this table has at most ``n`` rows and
   is broadcast; with keys it is joined by a balanced shuffle on (key, partition), which AQE
   turns into a broadcast when the measured table is small.

Steps 3 and 4 both read the numbered rows. Two separately planned range exchanges could pick
different boundaries (their samples depend on the upstream row order and on how AQE coalesced
the upstream, which differ between a wide and a column-pruned read), so the range-partitioned,
position-numbered rows are materialised once as a reliable checkpoint in the shared checkpoint
folder and both steps read that. The function therefore runs one job when called.

The order must be total (end it with a unique column or all columns), otherwise rows that tie
get their numbers in an arbitrary order, exactly as with the window function. Rows that are equal in
all sort columns cannot be told apart by a range, so the range order ends with a row number of the
input: a third of the table made of one repeated row is spread over tasks like any other rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import shared_root, shuffle_partitions

_POS = "__pos"
_PID = "__pid"
_FIRST = "__first"
_COUNT = "__n"
_BEFORE = "__before"
_SPREAD = "__spread"


def sort_spec(order_by: Sequence[str | Column]) -> list[Column]:
    """Names become ascending, nulls first (Spark's default); Columns are kept as given."""
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_by]


def range_numbered(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str | Column], num_partitions: int | None = None
) -> DataFrame:
    """Steps 1-2: rows range-partitioned on (keys, order), with position and range partition id,
    materialised as a reliable checkpoint (columns ``__pos`` and ``__pid``)."""
    n = num_partitions or max(shuffle_partitions(df.sparkSession), 1)
    spec = [F.col(k).asc_nulls_first() for k in partition_by] + sort_spec(order_by) + [F.col(_SPREAD)]
    shared_root(df.sparkSession)
    return (
        df.withColumn(_SPREAD, F.monotonically_increasing_id())
        .repartitionByRange(n, *spec)
        .sortWithinPartitions(*spec)
        .drop(_SPREAD)
        .withColumn(_POS, F.monotonically_increasing_id())
        .withColumn(_PID, F.shiftright(F.col(_POS), 33))
        .checkpoint(eager=True)
    )


def distributed_row_number(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str | Column],
    out: str = "row_num",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``out`` (bigint) = row_number() over (partition by ``partition_by`` order by ``order_by``)."""
    keys = list(partition_by)
    ranged = range_numbered(df, keys, order_by, num_partitions)
    runs = ranged.groupBy(*keys, _PID).agg(F.min(_POS).alias(_FIRST), F.count(F.lit(1)).alias(_COUNT))
    earlier = Window.partitionBy(*keys).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn(_BEFORE, F.coalesce(F.sum(_COUNT).over(earlier), F.lit(0)))
    if keys:
        runs = runs.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], _PID, _FIRST, _BEFORE)
        cond = [ranged[k].eqNullSafe(runs[f"__k{i}"]) for i, k in enumerate(keys)] + [ranged[_PID] == runs[_PID]]
        joined = ranged.join(runs, cond, "inner").drop(runs[_PID])
        joined = joined.drop(*[f"__k{i}" for i in range(len(keys))])
    else:
        # at most n rows: one per range partition
        joined = ranged.join(F.broadcast(runs.select(_PID, _FIRST, _BEFORE)), _PID, "inner")
    numbered = joined.withColumn(out, F.col(_POS) - F.col(_FIRST) + F.col(_BEFORE) + F.lit(1))
    return numbered.drop(_POS, _PID, _FIRST, _BEFORE)
