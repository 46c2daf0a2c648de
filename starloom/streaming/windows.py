"""Event-time streams: hourly totals, first rows, and corrections that meet their sales.

Each function starts a query over the files that arrive in a folder and appends finished rows to Parquet
with Spark's file sink, so the checkpoint makes the output exactly-once. ``trigger(availableNow)`` takes what is
there and stops; started again on the same checkpoint, the query goes on with its state and watermark. State is
keyed and spread over ``spark.sql.shuffle.partitions`` tasks of the first run, and bounded by the watermark:

* hourly totals keep the open hours only, one row per key and hour;
* first rows keep a key until the watermark is ``delay`` past it;
* corrections keep either side for the join's span beyond the watermark.

Rows behind the watermark when they arrive are late. Spark drops them from stateful operators and counts them;
``late_totals`` tells how many rows and how much each closed hour lacks because of them, so that they are added
and not lost. Rows without an event time belong to no hour and to no span; ``first_rows`` and ``corrections`` leave
them out. Repeated rows count each in totals. An empty delivery changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

HOUR = "1 hour"


def arriving(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """The files of a folder as a stream, with a declared schema."""
    return spark.readStream.format(fmt).schema(schema).load(path)


def appended(stream: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Start the query: what is finished goes to ``sink``, what is there is processed, then it stops."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", sink).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def _windowed(rows: DataFrame, keys: Sequence[str], at: str, value: Column, width: str) -> DataFrame:
    # the window's start is a column of its own: the sink needs no structs, the watermark goes with the window
    grouped = rows.groupBy(F.window(at, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return grouped.select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "total")


def window_totals(
    stream: DataFrame, keys: Sequence[str], at: str, value: Column, delay: str, width: str = HOUR
) -> DataFrame:
    """``keys, start, end, n, total``: rows and sum of ``value`` per key and window, each emitted once, when
    the watermark (the greatest time seen less ``delay``) has passed the window's end."""
    return _windowed(stream.withWatermark(at, delay), keys, at, value, width)


def late_totals(source: DataFrame, emitted: DataFrame, keys: Sequence[str], at: str, value: Column, closed_until: Column, width: str = HOUR) -> DataFrame:
    """``keys, start, end, n, total, n_late, total_late`` for every window that has ended by ``closed_until``:
    what was emitted, and what ``source`` (all delivered rows) has beyond that. A window with late rows only
    has ``n`` 0. One aggregate of the source and one join on keys and window; null keys are equal."""
    whole = _windowed(source, keys, at, value, width).filter(F.col("end") <= closed_until)
    whole = whole.select(F.struct(*keys, "start", "end").alias("k"), F.col("n").alias("all_n"), F.col("total").alias("all_total"))
    seen = emitted.select(F.struct(*keys, "start", "end").alias("k"), "n", "total")
    joined = whole.join(seen, "k", "left")
    n, total = F.coalesce("n", F.lit(0)), F.coalesce("total", F.lit(0))
    return joined.select(
        *[F.col("k")[c].alias(c) for c in (*keys, "start", "end")], n.cast("bigint").alias("n"), total.alias("total"),
        (F.col("all_n") - n).alias("n_late"), (F.coalesce("all_total", F.lit(0)) - total).alias("total_late"),
    )


def first_rows(stream: DataFrame, keys: Sequence[str], at: str, delay: str) -> DataFrame:
    """One row per key: the first that arrives. A key is remembered until the watermark has passed its row's
    time by ``delay``, so repeats up to ``delay`` apart are found."""
    return stream.filter(F.col(at).isNotNull()).withWatermark(at, delay).dropDuplicatesWithinWatermark(list(keys))


def corrections(sales: DataFrame, changes: DataFrame, key: str, sold_at: str, changed_at: str, within: str, delay: str) -> DataFrame:
    """Each sale with each of its corrections at most ``within`` after it. Both sides wait in state for
    the other, no longer than the watermarks and ``within`` allow."""
    left = sales.filter(F.col(sold_at).isNotNull()).withWatermark(sold_at, delay).alias("s")
    right = changes.filter(F.col(changed_at).isNotNull()).withWatermark(changed_at, delay).withColumnRenamed(key, "__key").alias("c")
    span = (F.col(changed_at) >= F.col(sold_at)) & (F.col(changed_at) <= F.col(sold_at) + F.expr(f"interval {within}"))
    return left.join(right, (F.col(f"s.{key}") == F.col("c.__key")) & span).drop("__key")
