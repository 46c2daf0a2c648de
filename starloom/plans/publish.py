"""Key-wise upsert into a versioned, partitioned table; only the touched partitions are written.

1. Lookup. The stored rows of the delivered keys, with key, hash and partition columns only: a semi join
   with the delivered keys, which AQE broadcasts once it has measured them small, so stored rows are
   scanned and not shuffled.
2. Classification. A delivered row is an insert (key unknown), an update (hash differs) or unchanged
   (dropped here). The changes are written once, as Parquet.
3. Touched partitions: those of the inserts and the stored ones of the updates (and, where a version
   may move, its new one). The stored rows of these partitions are read from the folders in the map, merged with
   the changes in one join and written to the run's version. There is one path for any number of
   partitions, and their values stay in Spark.

Merging the same delivery again finds no change and writes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import merge
from starloom.plans.store import Run, Store, _null_safe

_TOUCHED = "__touched_"
_KNOWN = "__known_"


@dataclass
class Changes:
    rows: DataFrame  # inserts and updates, in the staging's columns
    touched: DataFrame  # distinct partition values to rewrite
    counts: dict[str, int]


def known_rows(run: Run, table: str, keys: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Stored rows whose key is in ``keys``: the key and ``columns``, renamed to ``__known_*``."""
    stored = run.store.read(table)
    narrow = stored.select(key, *[F.col(c).alias(f"{_KNOWN}{c}") for c in columns], F.lit(True).alias(f"{_KNOWN}row"))
    return narrow.join(keys.select(key), key, "left_semi")


def changes_of(
    run: Run, looked_up: DataFrame, columns: Sequence[str], hash_col: str, parts: Sequence[str], moves_rows: bool = False
) -> Changes:
    """Split delivered rows, left-joined with ``known_rows`` (hash and partition columns), into changes.

    An insert touches its own partition, an update the stored one and, with ``moves_rows`` (a type 2
    version may land elsewhere), its own too. Presence is a marker column, not a null key.
    """
    is_insert = F.col(f"{_KNOWN}row").isNull()
    is_update = ~is_insert & ~F.col(hash_col).eqNullSafe(F.col(f"{_KNOWN}{hash_col}"))
    changes = looked_up.filter(is_insert | is_update).select(
        *columns, is_insert.alias("__insert"), *[F.when(is_insert, F.col(c)).otherwise(F.col(f"{_KNOWN}{c}")).alias(f"{_TOUCHED}{c}") for c in parts]
    )
    changes = run.work(changes, "changes")
    touched = changes.select(*[F.col(f"{_TOUCHED}{c}").alias(c) for c in parts])
    if moves_rows:
        touched = touched.unionByName(changes.select(*parts))
    inserts, updates = changes.agg(F.count_if("__insert"), F.count_if(~F.col("__insert"))).first()
    return Changes(changes.select(*columns), run.work(touched.distinct(), "touched"), {merge.INSERT: inserts, merge.UPDATE: updates})


def rewrite_touched(
    run: Run, table: str, changes: Changes, parts: Sequence[str], merge_fn: Callable[[DataFrame, DataFrame], DataFrame]
) -> dict[str, int]:
    """Merge the changes into the touched partitions; ``merge_fn(changes, target)`` returns the merged
    rows (a ``change_type`` column is dropped)."""
    if changes.counts[merge.INSERT] + changes.counts[merge.UPDATE]:
        store = run.store
        stored = store.map_of(table)
        within = stored.join(changes.touched, _null_safe(stored, changes.touched, parts), "left_semi")
        target = store.read(table, within=within)
        merged = merge_fn(changes.rows.select(*target.columns), target).drop("change_type")
        run.rewrite(table, merged, changes.touched, parts)
    return changes.counts


def upsert(
    run: Run,
    table: str,
    staging: DataFrame,
    key: str = "trx_id",
    hash_col: str = "record_hash",
    parts: Sequence[str] = ("year", "month"),
) -> dict[str, int]:
    """Type 1 upsert of prepared rows: one row per key, no null key, hash and partition columns present,
    materialised by the caller."""
    if not run.store.has(table):
        run.replace(table, staging, parts)
        return {merge.INSERT: run.rows_of(table), merge.UPDATE: 0}
    known = known_rows(run, table, staging, key, [hash_col, *parts])
    changes = changes_of(run, staging.join(known, key, "left"), staging.columns, hash_col, parts)
    return rewrite_touched(run, table, changes, parts, lambda new, target: merge.merge_scd1(new, target, key=key, hash_col=hash_col, on_duplicate="unique").merged)


def upsert_batch(
    spark: SparkSession,
    root: str,
    staging: DataFrame,
    table: str = "sales_fact",
    key: str = "trx_id",
    hash_col: str = "record_hash",
    parts: Sequence[str] = ("year", "month"),
    dedup_order: Sequence[str] = ("transacted_at", "record_hash"),
    batch: str = "batch",
) -> dict[str, int]:
    """Merge one delivery of staging rows into ``table`` below ``root`` and commit it.

    The delivery is evaluated once. Rows with a null key cannot be matched; they become the partition
    ``batch`` of ``<table>_rejects``, so repeating a delivery under its name adds nothing.
    """
    store = Store(spark, root)
    run = store.begin()
    staging = run.work(staging, "staging")
    rejects = staging.filter(F.col(key).isNull()).withColumn("batch", F.lit(batch))
    if store.has(f"{table}_rejects") or rejects.limit(1).count():  # of the written copy: its statistics answer
        run.rewrite(f"{table}_rejects", rejects, spark.range(1).select(F.lit(batch).alias("batch")), ["batch"])
    keyed = merge.latest_per_key(staging.filter(F.col(key).isNotNull()), key, [c for c in dedup_order if c in staging.columns])
    counts = upsert(run, table, run.work(keyed, "keyed"), key, hash_col, parts)
    run.commit(f"upsert/{table}")
    return counts
