"""The batch job (C7): one run of the warehouse load, gated by the stored high-water mark.

Order of a run (every step is a Spark job over the whole input; the driver only receives the
one-row decision and counts):

1. schema check of the three inputs (names; types with ``strict_types``);
2. decision from the batch maximum and the stored mark: first load, incremental or skip;
3. employee quality split from one ranking; the audit is written as CSV with its reasons;
4. surrogate keys: new natural keys join the key map, then all ids are attached;
5. the sales to load, one row per key, are materialised once and feed the fact, the dates and the
   counts. First load: every table is replaced. Incremental: type 1 merge into the touched fact
   partitions, type 2 merge of the touched departments, dates added to the stored ones;
6. one appended control row commits the versions of all tables and the mark.

Nothing a run writes is visible before step 6 (``plans.store``), so a run that stops anywhere, also
in the middle of a write, leaves the tables of the last commit, and is simply run again.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field
from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import schemas
from starloom.operators import control, dims, facts, merge, quality
from starloom.plans import publish
from starloom.plans.store import OnWrite, Run, Store
from starloom.session import written
from starloom.sources.io import delete_path, read_table

#: Column that holds an input line which its schema cannot parse.
CORRUPT = "corrupt_record"


@dataclass
class BatchOutcome:
    decision: str
    stored_mark: dt.datetime | None
    batch_max: dt.datetime | None
    metrics: dict = field(default_factory=dict)


def interval(lookback: dt.timedelta | str | None) -> str | None:
    if isinstance(lookback, dt.timedelta):
        return f"{lookback // dt.timedelta(microseconds=1)} microseconds"
    return lookback


def _fact_update_columns(change_on: str) -> list[str]:
    cols = list(schemas.SALES_UPDATE_COLUMNS)
    return cols + ["strict_hash"] if change_on == "strict_hash" else cols


def run_batch(
    spark: SparkSession,
    employees: DataFrame,
    sales: DataFrame,
    cities: DataFrame,
    root: str,
    as_of: dt.date,
    lookback: dt.timedelta | str | None = None,
    tie_breakers: list[str] | None = None,
    strict_types: bool = False,
    mark_granularity: str = "exact",
    natural_key: list[str] | None = None,
    clean: bool = False,
    change_on: str = "record_hash",
    fmt: str = "parquet",
    corrupt: Mapping[str, DataFrame] | None = None,
    on_write: OnWrite | None = None,
) -> BatchOutcome:
    """Run one load into ``root``; returns the decision and the counts.

    ``lookback`` re-reads source rows up to that long before the stored mark (late corrections); a
    delivery whose latest sale lies in that window is loaded too, and never moves the mark back. A
    delivery that is skipped is skipped as a whole, its employees included.
    ``mark_granularity="day"`` stores the last microsecond of the greatest date instead of the
    exact greatest timestamp (later rows of that day then count as processed).
    ``clean=True`` trims names and lower-cases e-mails (V7) before the quality rules.
    ``change_on="strict_hash"`` also stores the injective row hash and detects changes with it
    (``(null, 'a')`` and ``('a', null)`` then differ); the default compares ``record_hash``.
    ``natural_key`` identifies a person for the surrogate key (default: the dedup business key).
    A narrower key such as ``["email"]`` tracks transfers as new versions; rows that share it
    after the quality split are deduplicated again with the same preference.
    ``fmt`` is the format of the published tables (the audit is always CSV).
    ``corrupt`` has the unparsable lines of each input by its name, in a column ``corrupt_record``;
    those of the employees go to the audit, those of the sales to the rejects, and all to
    ``corrupt_lines``.
    ``on_write`` is called for each write of a published table, see ``plans.store``.
    """
    if mark_granularity not in ("exact", "day"):
        raise ValueError("mark_granularity must be 'exact' or 'day'")
    if change_on not in ("record_hash", "strict_hash"):
        raise ValueError("change_on must be 'record_hash' or 'strict_hash'")
    strict = change_on == "strict_hash"
    natural_key = list(natural_key or schemas.EMPLOYEE_KEY)
    quality.check_schema(employees, schemas.EMPLOYEES, strict_types)
    quality.check_schema(sales, schemas.SALES, strict_types)
    quality.check_schema(cities, schemas.CITIES, strict_types)

    store = Store(spark, root, fmt)
    run = store.begin(on_write)
    mark_col = "day_mark" if mark_granularity == "day" else "max_ts"
    decision = run.work(control.decide(facts.batch_max(sales), store.control(), mark_col=mark_col, lookback=interval(lookback)), "decision")
    row = decision.select("decision", "stored_mark", "batch_max").first()
    outcome = BatchOutcome(row["decision"], row["stored_mark"], row["batch_max"])
    if outcome.decision == control.SKIP:
        run.close()
        return outcome

    # 3. quality split, counts and audit
    if clean:
        employees = quality.clean_employees(employees)
    split = quality.split_employees(employees, tie_breakers=tie_breakers)
    outcome.metrics.update(split.counts().first().asDict())
    audit = quality.audit_for_csv(split.audit)
    if corrupt:
        audit = _publish_corrupt(run, audit, corrupt, outcome)
    run.replace("audit", audit, fmt="csv")

    # 4. surrogate keys, stable across runs
    people = split.valid
    if natural_key != schemas.EMPLOYEE_KEY:
        people = quality.survivors(people, natural_key, tie_breakers=tie_breakers)
    people = run.work(people, "people")
    key_map = store.read("key_map") if store.has("key_map") else None
    new_keys = run.work(dims.assign_keys(people, natural_key, key_map, keys_unique=True).new_keys, "new-keys")
    run.append("key_map", new_keys)
    with_ids = dims.attach_keys(people, new_keys if key_map is None else key_map.unionByName(new_keys), natural_key)
    staged = facts.employee_staging(with_ids.select("emp_id", *schemas.EMPLOYEES.fieldNames()), as_of, strict=strict)

    # a city may move to another country, so its dimension is always replaced as a whole
    run.replace("city_dim", dims.city_dim(cities), schemas.CITY_DIM_PARTITIONS)

    if outcome.decision == control.FIRST_LOAD:
        _first_load(run, people, staged, sales, outcome, change_on)
    else:
        lower = decision.select("lower").scalar()
        _incremental(run, people, run.work(staged, "employees"), control.incremental_slice(sales, lower), as_of, outcome, change_on)

    run.commit(control.SALES_MARK_KEY, decision.select(F.greatest("stored_mark", "batch_max").alias("mark_value")))
    return outcome


def _publish_corrupt(run: Run, audit: DataFrame, corrupt: Mapping[str, DataFrame], outcome: BatchOutcome) -> DataFrame:
    """Keep the unparsable lines of this delivery; returns the audit with those of the employees."""
    lines = [df.select(F.lit(name).alias("input"), CORRUPT) for name, df in corrupt.items()]
    kept = run.work(quality.union_all(lines).withColumn("batch", F.lit(_batch_name(run))), "corrupt")
    run.rewrite("corrupt_lines", kept, kept.sparkSession.range(1).select(F.lit(_batch_name(run)).alias("batch")), ["batch"])
    outcome.metrics.update({f"corrupt_{r['input']}": r["count"] for r in kept.groupBy("input").count().collect()})
    bad = kept.filter(F.col("input") == "employees").select(CORRUPT, F.lit(quality.REASON_CORRUPT).alias("reasons"))
    return audit.withColumn(CORRUPT, F.lit(None).cast("string")).unionByName(bad, allowMissingColumns=True)


def _batch_name(run: Run) -> str:
    return f"load-{run.store.seq + 1:08d}"


# Fixed order among several deliveries of one sale: latest transacted_at, then the values.
_SALES_DEDUP_ORDER = ["transacted_at", "retailer_id", "description", "amount", "city_id"]


def _keyed_sales(run: Run, sales: DataFrame, outcome: BatchOutcome) -> DataFrame:
    """The sales to load, one row per key, materialised once; null keys become this load's rejects.

    The fact keeps one row per trx_id (every later merge relies on it), so the first load applies the
    same rules as the incremental merge."""
    batch = _batch_name(run)
    rejects = sales.filter(F.col("trx_id").isNull()).withColumn("batch", F.lit(batch))
    run.rewrite("rejects", rejects, run.spark.range(1).select(F.lit(batch).alias("batch")), ["batch"])
    keyed = merge.latest_per_key(sales.filter(F.col("trx_id").isNotNull()), "trx_id", _SALES_DEDUP_ORDER)
    keyed = run.work(keyed, "sales")
    outcome.metrics["sales_rows"] = keyed.count()
    return keyed


def _first_load(run: Run, people: DataFrame, staged: DataFrame, sales: DataFrame, outcome: BatchOutcome, change_on: str) -> None:
    run.replace("employee_dim", staged, schemas.EMPLOYEE_DIM_PARTITIONS)
    keyed = _keyed_sales(run, sales, outcome)
    fact = facts.sales_staging(facts.add_year_month(facts.assign_employee(keyed, people)), strict=change_on == "strict_hash")
    run.replace("sales_fact", fact, schemas.SALES_FACT_PARTITIONS)
    outcome.metrics["fact_rows"] = run.rows_of("sales_fact")
    run.replace("date_dim", dims.date_dim(keyed))


def _incremental(run: Run, people: DataFrame, staged: DataFrame, sales: DataFrame, as_of: dt.date, outcome: BatchOutcome, change_on: str) -> None:
    keyed = _keyed_sales(run, sales, outcome)

    # type 1 merge of the sales into the touched fact partitions
    parts = schemas.SALES_FACT_PARTITIONS
    known = publish.known_rows(run, "sales_fact", keyed, "trx_id", [change_on, *parts, "emp_id"])
    # a stored sale keeps its employee; a new one gets the hash assignment of this run
    assigned = facts.assign_employee(keyed.join(known, "trx_id", "left"), people, out="__new_emp").withColumn(
        "emp_id", F.coalesce(F.col("__known_emp_id"), F.col("__new_emp"))
    )
    prepared = facts.sales_staging(facts.add_year_month(assigned), strict=change_on == "strict_hash")
    columns = run.store.tables["sales_fact"].fields.fieldNames()
    changes = publish.changes_of(run, prepared, columns, change_on, parts)
    counts = publish.rewrite_touched(
        run, "sales_fact", changes, parts,
        lambda new, target: merge.merge_scd1(new, target, update_columns=_fact_update_columns(change_on), hash_col=change_on, on_duplicate="unique").merged,
    )
    outcome.metrics.update({f"fact_{k}": v for k, v in counts.items()})

    # type 2 merge of the employee dimension: only departments with new or changed employees
    parts = schemas.EMPLOYEE_DIM_PARTITIONS
    known = publish.known_rows(run, "employee_dim", staged, "emp_id", [change_on, *parts, "is_current"])
    known = known.filter(F.coalesce("__known_is_current", F.lit(False)))
    changes = publish.changes_of(run, staged.join(known, "emp_id", "left"), staged.columns, change_on, parts, moves_rows=True)
    counts = publish.rewrite_touched(
        run, "employee_dim", changes, parts, lambda new, target: merge.merge_scd2(new, target, as_of, hash_col=change_on)
    )
    outcome.metrics.update({f"employee_{merge.NEW}": counts[merge.INSERT], f"employee_{merge.CHANGED}": counts[merge.UPDATE]})

    # dates of this slice together with the stored ones
    run.replace("date_dim", dims.date_dim(keyed, stored=run.store.read("date_dim")))


def run_batch_from(spark: SparkSession, paths: Mapping[str, str], root: str, as_of: dt.date, fmt: str = "csv", **options) -> BatchOutcome:
    """Run one load from files: ``paths`` has those of ``employees``, ``sales`` and ``cities`` in ``fmt``.

    Files are read with the declared schemas. Text files are parsed once, into columns; lines that do
    not parse are kept apart and published (see ``corrupt`` of ``run_batch``) instead of becoming rows
    of nulls.
    """
    work = f"{root.rstrip('/')}/_work/parsed-{uuid.uuid4().hex[:8]}"
    inputs, corrupt = {}, {}
    for name, schema in (("employees", schemas.EMPLOYEES), ("sales", schemas.SALES), ("cities", schemas.CITIES)):
        if fmt in ("csv", "json"):
            df = written(read_table(spark, paths[name], fmt, schema, corrupt_column=CORRUPT), f"{work}/{name}")
            corrupt[name] = df.filter(F.col(CORRUPT).isNotNull())
            inputs[name] = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
        else:
            inputs[name] = read_table(spark, paths[name], fmt, schema)
    outcome = run_batch(spark, inputs["employees"], inputs["sales"], inputs["cities"], root, as_of, corrupt=corrupt or None, **options)
    delete_path(spark, work)
    return outcome


def published(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table as of the last commit."""
    return Store(spark, root).read(table)
