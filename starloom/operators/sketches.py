"""Mergeable sketches per partition: distinct counts and quantiles that a run renews where rows have changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: HyperLogLog with 2^LG_K registers, and the standard error of its estimate.
LG_K = 12
HLL_ERROR = 1.04 / 2 ** (LG_K / 2)
#: KLL parameter; a quantile's rank is within KLL_RANK_ERROR of the asked one (99 % of the time).
KLL_K = 200
KLL_RANK_ERROR = 0.0265


def partition_sketches(rows: DataFrame, parts: Sequence[str], distinct: str, quantile: str) -> DataFrame:
    """``parts, n, distinct_sketch, quantile_sketch`` of the rows of each partition. Sketches are built by partial
    aggregates: a task sends a few kilobytes per partition, however many rows it has. Nulls are not counted;
    a partition without any value has an empty sketch."""
    return rows.groupBy(*parts).agg(
        F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(distinct, F.lit(LG_K)).alias("distinct_sketch"),
        F.kll_sketch_agg_double(F.col(quantile).cast("double"), F.lit(KLL_K)).alias("quantile_sketch"),
    )


def merged_sketches(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches of coarser groups from stored ones, without reading any row again."""
    return sketches.groupBy(*by).agg(
        F.sum("n").alias("n"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch")
    )


def estimates(sketches: DataFrame, ranks: Sequence[float] = (0.5,)) -> DataFrame:
    """``sketches`` with ``about_distinct`` and ``about_quantiles`` (at ``ranks``; null without values) instead of the sketches."""
    some = F.kll_sketch_get_n_double("quantile_sketch") > 0
    found = F.when(some, F.array(*[F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(r)) for r in ranks]))
    return sketches.withColumns({"about_distinct": F.hll_sketch_estimate("distinct_sketch"), "about_quantiles": found}).drop("distinct_sketch", "quantile_sketch")
