"""Joins by range and comparisons of bags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.scan import SUM, Running, running


def range_join(
    points: DataFrame, bands: DataFrame, value: str, lower: str, upper: str, width: float, how: str = "inner", sums: dict[str, Column] | None = None
) -> DataFrame:
    """Each point with each band that holds its ``value``: ``lower <= value < upper``, a null bound being open.

    A band becomes a row per bin of ``width`` that it touches, no further than the points reach; points and bands
    meet by equality on the bin and the bounds decide. So no pair outside a common bin is made, and a crowded
    bin is an ordinary join key, which adaptive execution splits on the points' side. Choose ``width`` near that
    of a usual band: a point is in one bin, a band in ``(upper - lower) / width + 1``. ``how`` is ``inner`` or
    ``left`` (points without a band are kept). Edge cases: a point with a null or NaN value has no band; a band
    whose bounds are equal or swapped holds nothing. Repeated rows of either side count each. No column of
    the two sides may have the same name.

    The pairs grow with the product of the sides. Who only adds them up by band gives ``sums`` (of the points'
    columns): then each band that holds a point is one row, its columns with ``n``, the number of its points, and the
    sums over them (see ``_sums_within``); ``width`` and ``how`` are for the pairs.
    """
    if sums is not None:
        if how != "inner":
            raise ValueError(f"sums are of the points that a band holds, not of a {how} join")
        return _sums_within(points, bands, value, lower, upper, sums)
    bin_of = lambda c: F.floor(c / F.lit(width)).cast("bigint")
    held = points.withColumn("__bin", F.when(~F.isnan(F.col(value).cast("double")), bin_of(F.col(value))))
    least, most = held.agg(F.min("__bin"), F.max("__bin")).first()
    low, high = F.coalesce(bin_of(F.col(lower)), F.lit(least)), F.coalesce(bin_of(F.col(upper)), F.lit(most))
    first, last = F.greatest(low, F.lit(least)), F.least(high, F.lit(most))
    cut = bands.withColumns({"__first": first, "__last": last}).filter(F.col("__first") <= F.col("__last"))
    cut = cut.withColumn("__band_bin", F.explode(F.sequence("__first", "__last"))).drop("__first", "__last")
    inside = (F.col(lower).isNull() | (F.col(value) >= F.col(lower))) & (F.col(upper).isNull() | (F.col(value) < F.col(upper)))
    return held.join(cut, (F.col("__bin") == F.col("__band_bin")) & inside, how).drop("__bin", "__band_bin")


def _sums_within(points: DataFrame, bands: DataFrame, value: str, lower: str, upper: str, sums: dict[str, Column]) -> DataFrame:
    """``bands`` with ``n`` and ``sums`` of the points that each holds, without a row per pair.

    Points and bounds become one sorted stream (``functions.scan.running``) in which the running sums arrive at each
    distinct bound; a band's are those at its upper bound less those at its lower one. So work grows with the sum of
    the sides, whatever the bands hold, and a crowded value spans tasks. Differences are exact for integers and
    decimals; other sums are refused. Edge cases as for the pairs; a sum of nulls alone is null.
    """
    names, kept = [f"__s{i}" for i in range(len(sums))], F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))
    held = points.filter(kept).select(F.col(value).alias("__at"), F.lit(1).alias("__n"), *[c.alias(s) for s, c in zip(names, sums.values())])
    kinds = [dict(held.agg(F.sum(s).alias(s)).dtypes)[s] for s in names]
    if inexact := [k for k in kinds if k != "bigint" and not k.startswith("decimal")]:
        raise ValueError(f"sums of {inexact[0]} are not exact as differences; give decimals")
    bounds = bands.filter(F.col(lower).isNotNull()).select(F.col(lower).alias("__at")).unionByName(bands.select(F.col(upper).alias("__at"))).distinct()

    # a bound stands before the points that are equal to it, an open upper one (null) behind all
    order = [F.col("__at").asc_nulls_last(), F.col("__n").asc_nulls_first()]
    parts = {"n": F.col("__n")} | {f"v{i}": F.col(s) for i, s in enumerate(names)} | {f"some{i}": F.col(s).isNotNull().cast("int") for i, s in enumerate(names)}
    carried = running(held.unionByName(bounds, allowMissingColumns=True), [], order, {f"__{c}_below": Running(SUM, v) for c, v in parts.items()})
    below = carried.filter(F.col("__n").isNull())
    side = lambda x: below.select(F.col("__at").alias(f"__{x}"), *[F.coalesce(f"__{c}_below", F.lit(0)).alias(f"__{x}_{c}") for c in parts])
    found = bands.join(side("up"), F.col(upper).eqNullSafe(F.col("__up"))).join(side("low"), F.col(lower) == F.col("__low"), "left")
    within = lambda c: F.col(f"__up_{c}") - F.coalesce(F.col(f"__low_{c}"), F.lit(0))
    totals = [F.when(within(f"some{i}") > 0, within(f"v{i}")).cast(k).alias(s) for i, (s, k) in enumerate(zip(sums, kinds))]
    return found.filter(within("n") > 0).select(*bands.columns, within("n").alias("n"), *totals)


def bag_difference(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows (by ``columns``) that one side has more often: ``columns, n_left, n_right``.

    One aggregate of both sides, with a partial sum per task, so that rows that are repeated very often meet as
    counts. Nulls are equal, also in floating-point columns NaN and NaN. Two equal bags give no row.
    """
    side = lambda df, a, b: df.select(*columns, F.lit(a).alias("l"), F.lit(b).alias("r"))
    counted = side(left, 1, 0).unionByName(side(right, 0, 1)).groupBy(*columns).agg(F.sum("l").alias("n_left"), F.sum("r").alias("n_right"))
    return counted.filter(F.col("n_left") != F.col("n_right"))
