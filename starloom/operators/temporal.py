"""Operators over time: as-of join, sums over a moving span, sessions.

All three read a neighbour in an order (the latest version before a sale, the running total before a span, the
sale before this one). They are built on ``functions.scan.running``, so a key with a third of all rows is spread
over range partitions, and no window holds a whole key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.scan import LAST, SUM, Running, running


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    at: str,
    since: str,
    columns: Sequence[str],
    until: str | None = None,
    inclusive: bool = True,
    num_partitions: int | None = None,
) -> DataFrame:
    """``left`` with ``columns`` of the right row of the same keys that is latest by ``since`` and not after
    ``at`` (before it, if not ``inclusive``). With ``until``, a right row no longer holds from then on; the
    earlier ones are not asked again.

    Both sides become one sorted stream in which the last right row is carried on: one shuffle of either side,
    no join on the key. Edge cases: a left row with a null key or time finds nothing, and right rows with one
    are never found; what is not found is null. Of right rows that tie in ``since`` the greatest by ``columns``
    counts. Repeated left rows are all kept. Empty tables are fine.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    kind = dict(left.dtypes)[at]
    payload = [F.col(c).alias(f"c{i}") for i, c in enumerate([*columns, *([until] if until else [])])]
    theirs = right.filter(F.col(since).isNotNull()).dropna(subset=list(keys)).select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(since).cast(kind).alias("__t"), F.lit(0 if inclusive else 1).alias("__side"), F.struct(*payload).alias("__r")
    )
    ours = left.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(at).alias("__t"), F.lit(1 if inclusive else 0).alias("__side"), F.struct(*[left[c] for c in left.columns]).alias("__l")
    )
    stream = theirs.unionByName(ours, allowMissingColumns=True)
    carried = running(stream, names, ["__t", "__side", "__r"], {"__m": Running(LAST, F.col("__r"))}, num_partitions)
    found = F.col("__m")
    if until:
        ends = F.col(f"__m.c{len(columns)}").cast(kind)
        found = F.when(ends.isNull() | (F.col("__t") < ends), F.col("__m"))
    found = F.when(F.col("__t").isNotNull(), found)
    return carried.filter(F.col("__l").isNotNull()).select("__l", found.alias("__m")).select("__l.*", *[F.col(f"__m.c{i}").alias(c) for i, c in enumerate(columns)])


def moving_sums(
    df: DataFrame, keys: Sequence[str], at: str, value: Column, span: str, num_partitions: int | None = None
) -> DataFrame:
    """One row per keys and time: ``n`` rows and ``total`` of ``value`` at that time or up to ``span`` (an
    interval, such as ``30 days``) before it, both ends included.

    The same as ``sum(value) over (partition by keys order by at range between span preceding and current
    row)``, computed as the running total less the running total before the span, which an as-of join finds. Give
    ``value`` as a decimal, so that the difference is exact. Edge cases: null keys are a group of their own; rows
    without a time are one of their own within it, with a null time. Rows that tie in time count together. A
    null value counts as a row and adds nothing; ``total`` is null if there is no other.
    """
    sums = df.select(*keys, F.col(at).alias(at), value.alias("v")).groupBy(*keys, at).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("v"), F.lit(0)).alias("v"), F.count("v").alias("some")
    )
    dated = sums.filter(F.col(at).isNotNull())
    parts = {"n": Running(SUM, F.col("n")), "v": Running(SUM, F.col("v")), "some": Running(SUM, F.col("some"))}
    totals = running(dated.withColumnsRenamed({c: f"own_{c}" for c in parts}), keys, [at], {c: Running(SUM, F.col(f"own_{c}")) for c in parts}, num_partitions)
    totals = totals.drop(*[f"own_{c}" for c in parts])
    # null keys would find nothing in a join
    marked = [F.struct(F.col(k)).alias(f"key_{i}") for i, k in enumerate(keys)]
    totals = totals.select(*marked, F.col(at), *parts)
    before = totals.select(*[f"key_{i}" for i in range(len(keys))], F.col(at).alias("since"), *[F.col(c).alias(f"before_{c}") for c in parts])
    low = totals.withColumn("low", F.col(at) - F.expr(f"interval {span}"))
    joined = as_of_join(low, before, [f"key_{i}" for i in range(len(keys))], "low", "since", [f"before_{c}" for c in parts], inclusive=False, num_partitions=num_partitions)
    moved = joined.select(
        *[F.col(f"key_{i}")[k].alias(k) for i, k in enumerate(keys)], at, *[(F.col(c) - F.coalesce(F.col(f"before_{c}"), F.lit(0))).alias(c) for c in parts]
    )
    kind = dict(sums.dtypes)["v"]
    undated = sums.filter(F.col(at).isNull()).select(*keys, at, *parts)
    return moved.unionByName(undated).select(*keys, at, F.col("n"), F.when(F.col("some") > 0, F.col("v")).cast(kind).alias("total"))


def sessions(df: DataFrame, keys: Sequence[str], at: str, gap: str, value: Column, num_partitions: int | None = None) -> DataFrame:
    """Rows of one key with at most ``gap`` (an interval) between neighbours: one row per session, ``start,
    last`` (its first and last time), ``n`` rows and ``total`` of ``value``.

    As ``session_window`` groups them, but a session may span tasks: a row starts a session if the one before is
    more than ``gap`` away, the running number of starts names the sessions, and these are aggregated with a
    partial sum per task. Edge cases: null keys are a group of their own; rows without a time are in no session and
    left out, as ``session_window`` does. Repeated rows count each.
    """
    rows = df.filter(F.col(at).isNotNull()).select(*keys, F.col(at).alias("at"), value.alias("v"))
    times = rows.groupBy(*keys, "at").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"))
    keyed = times.select(*[F.struct(F.col(k)).alias(f"key_{i}") for i, k in enumerate(keys)], "at", "n", "v")
    key = [f"key_{i}" for i in range(len(keys))]
    prior = as_of_join(keyed, keyed.select(*key, F.col("at").alias("prior")), key, "at", "prior", ["prior"], inclusive=False, num_partitions=num_partitions)
    starts = (F.col("prior").isNull() | (F.col("at") > F.col("prior") + F.expr(f"interval {gap}"))).cast("int")
    numbered = running(prior.withColumn("starts", starts), key, ["at"], {"session": Running(SUM, F.col("starts"))}, num_partitions)
    out = numbered.groupBy(*key, "session").agg(F.min("at").alias("start"), F.max("at").alias("last"), F.sum("n").alias("n"), F.sum("v").alias("total"))
    return out.select(*[F.col(f"key_{i}")[k].alias(k) for i, k in enumerate(keys)], "start", "last", "n", "total")
