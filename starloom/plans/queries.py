"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver tables through ``plans.fixtures`` (so its work grows with the
scale factor) and returns a DataFrame. Queries that publish tables run their writes into a
fresh folder under the shared root first and return the table read back.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starloom import schemas
from starloom.functions.hashing import record_hash
from starloom.operators import bands, control, dims, facts, merge, quality, sketches, temporal, totals
from starloom.plans import batch
from starloom.plans import fixtures as fx
from starloom.plans.store import Run, Store
from starloom.session import scratch_path
from starloom.sources import variants
from starloom.sources.io import WriteMode, read_table, write_table
from starloom.streaming import windows

Query = Callable[[SparkSession, str], DataFrame]

# fixture tie-breaker: the source id makes the dedup order total
_TIE = ["src_id"]


# ---------------------------------------------------------------- sources and sinks


def _sales_with_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.add_year_month(fx.sales(spark, sf_dir))


def _roundtrip(fmt: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = _sales_with_calendar(spark, sf_dir)
        path = scratch_path(spark, f"roundtrip-{fmt}")
        write_table(df, path, fmt=fmt, mode=WriteMode.OVERWRITE, partition_by=["year", "month"])
        return read_table(spark, path, fmt=fmt, schema=df.schema)

    query.__name__ = f"source_{fmt}_roundtrip"
    return query


def write_modes_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwrite, dynamic partition overwrite of the first half of 1998, ignore, error, append."""
    from pyspark.errors import AnalysisException

    parts = ["year", "month"]
    before = facts.add_year_month(fx.sales_before(spark, sf_dir))
    after = facts.add_year_month(fx.sales_after(spark, sf_dir))
    half_year = after.filter((F.col("year") == 1998) & (F.col("month") <= 6))
    path = scratch_path(spark, "write-modes")
    write_table(before, path, mode=WriteMode.OVERWRITE, partition_by=parts)
    write_table(half_year, path, mode=WriteMode.OVERWRITE, partition_by=parts)  # replaces 6 partitions only
    write_table(after, path, mode=WriteMode.IGNORE, partition_by=parts)  # table exists: no-op
    try:
        write_table(after, path, mode=WriteMode.ERROR_IF_EXISTS, partition_by=parts)
        raise AssertionError("errorifexists wrote into an existing table")
    except AnalysisException:
        pass
    undated = after.filter(F.col("transacted_at").isNull())
    write_table(undated, path, mode=WriteMode.APPEND, partition_by=parts)
    return read_table(spark, path, schema=before.schema)


# ---------------------------------------------------------------- quality


def schema_check_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.union_all(
        [
            quality.schema_report(fx.employees(spark, sf_dir), schemas.EMPLOYEES, "employees"),
            quality.schema_report(fx.sales(spark, sf_dir), schemas.SALES, "sales"),
            quality.schema_report(fx.cities(spark, sf_dir), schemas.CITIES, "cities"),
        ]
    )


def clean_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.clean_employees(fx.employees(spark, sf_dir))


def email_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.flag_email(fx.employees(spark, sf_dir))


def employee_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rank_employees(fx.employees(spark, sf_dir), tie_breakers=_TIE)


def employee_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6: cleaning, flag and rank chained with ``transform``."""
    flagged = fx.employees(spark, sf_dir).transform(quality.clean_employees).transform(quality.flag_email)
    return flagged.transform(quality.rank_employees, tie_breakers=_TIE)


def _split(spark: SparkSession, sf_dir: str) -> quality.QualitySplit:
    return quality.split_employees(fx.employees(spark, sf_dir), tie_breakers=_TIE)


def valid_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.valid_employees(fx.employees(spark, sf_dir), tie_breakers=_TIE)


def bad_employee_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.audit_for_csv(_split(spark, sf_dir).audit)


def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir).counts()


def employee_rules_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.employee_rules(fx.employees(spark, sf_dir), fx.AS_OF).valid


def employee_rules_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.employee_rules(fx.employees(spark, sf_dir), fx.AS_OF).bad


# ---------------------------------------------------------------- dimensions and facts


def city_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.city_dim(fx.cities(spark, sf_dir))


def sales_city_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.enrich_with_city(fx.sales(spark, sf_dir), dims.city_dim(fx.cities(spark, sf_dir)), how="inner")


def sales_city_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.enrich_with_city(fx.sales(spark, sf_dir), dims.city_dim(fx.cities(spark, sf_dir)), how="left")


def sales_city_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.enrich_with_city(fx.sales(spark, sf_dir), dims.city_dim(fx.cities(spark, sf_dir)), how="left_anti")


def employee_dim_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.assign_keys(valid_employees(spark, sf_dir), schemas.EMPLOYEE_KEY, keys_unique=True).rows


def sales_fact_assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.assign_employee(fx.sales(spark, sf_dir), valid_employees(spark, sf_dir))


def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.date_dim(fx.sales(spark, sf_dir))


def sales_max_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.batch_max(fx.sales(spark, sf_dir))


def sales_year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.add_year_month(fx.sales(spark, sf_dir))


def sales_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.sales_staging(sales_fact_assigned(spark, sf_dir), strict=True)


def employee_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.employee_staging(employee_dim_ids(spark, sf_dir), fx.AS_OF)


# ---------------------------------------------------------------- merges


def _scd1_side(df: DataFrame) -> DataFrame:
    """Fixture sales as a fact: constant emp_id, calendar columns, row hash."""
    return facts.sales_staging(facts.add_year_month(df.withColumn("emp_id", F.lit(1).cast("bigint"))))


def _scd1(spark: SparkSession, sf_dir: str) -> merge.Scd1Result:
    staging = _scd1_side(fx.sales_after(spark, sf_dir))
    target = _scd1_side(fx.sales_before(spark, sf_dir))
    return merge.merge_scd1(staging, target)


def scd1_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scd1(spark, sf_dir).merged.drop("change_type")


def scd1_change_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scd1(spark, sf_dir).merged.groupBy("change_type").agg(F.count(F.lit(1)).alias("n_rows"))


def scd1_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = _scd1_side(fx.sales_after(spark, sf_dir))
    target = _scd1_side(fx.sales_before(spark, sf_dir))
    return merge.merge_scd1_snapshot(staging, target)


def scd1_strict_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The type 1 merge with changes detected by the injective hash."""
    side = lambda df: facts.sales_staging(facts.add_year_month(df.withColumn("emp_id", F.lit(1).cast("bigint"))), strict=True)
    columns = [*schemas.SALES_UPDATE_COLUMNS, "strict_hash"]
    staging, target = side(fx.sales_after(spark, sf_dir)), side(fx.sales_before(spark, sf_dir))
    return merge.merge_scd1(staging, target, update_columns=columns, hash_col="strict_hash").merged


def scd1_merge_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored state holds rows without key (as ``null_key="insert"`` leaves them); they stay."""
    before = fx.sales_before(spark, sf_dir).withColumn("trx_id", F.when(F.col("trx_id") % 50 != 1, F.col("trx_id")))
    return merge.merge_scd1(_scd1_side(fx.sales_after(spark, sf_dir)), _scd1_side(before)).merged


def _scd2(spark: SparkSession, sf_dir: str, emp_id: Column | str = "emp_id") -> DataFrame:
    staging = facts.employee_staging(fx.emp_after(spark, sf_dir), fx.AS_OF)
    before = fx.emp_before(spark, sf_dir).withColumn("emp_id", F.col(emp_id) if isinstance(emp_id, str) else emp_id)
    target = before.withColumn("record_hash", record_hash(schemas.EMPLOYEE_HASH_COLUMNS)).select(
        *[c for c in staging.columns if c not in schemas.SCD2_COLUMNS], *schemas.SCD2_COLUMNS
    )
    return merge.merge_scd2(staging, target, fx.AS_OF)


def scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scd2(spark, sf_dir)


def scd2_merge_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored dimension holds current rows without key; they stay, and stay single."""
    return _scd2(spark, sf_dir, F.when(F.col("emp_id") % 20 != 1, F.col("emp_id")))


def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scd2(spark, sf_dir).filter(F.col("is_current")).drop("change_type")


# ---------------------------------------------------------------- control


def watermark_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.latest_marks(fx.control_history(spark, sf_dir))


def batch_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    decision = control.decide(facts.batch_max(fx.sales(spark, sf_dir)), fx.control_history(spark, sf_dir))
    return decision.drop("stored_seq", "lower")


def incremental_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = control.stored_mark(fx.control_history(spark, sf_dir))
    return control.incremental_slice(fx.sales(spark, sf_dir), mark)


# ---------------------------------------------------------------- the batch job

# The second run re-reads a year before the stored mark (late corrections).
_LOOKBACK = dt.timedelta(days=365)


def _load(spark: SparkSession, inputs: tuple[DataFrame, DataFrame, DataFrame], root: str, day: int = 0, **options) -> batch.BatchOutcome:
    emp, sales, cities = inputs
    return batch.run_batch(spark, emp, sales, cities, root, fx.AS_OF + dt.timedelta(days=day), **{"tie_breakers": _TIE, **options})


def _two_loads(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Root of a first load followed by an incremental one."""
    root = scratch_path(spark, name)
    _load(spark, fx.batch_inputs(spark, sf_dir, 1), root)
    _load(spark, fx.batch_inputs(spark, sf_dir, 2), root, day=1, lookback=_LOOKBACK)
    return root


def batch_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "batch-first")
    _load(spark, fx.batch_inputs(spark, sf_dir, 0), root)
    return batch.published(spark, root, "sales_fact")


def batch_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch.published(spark, _two_loads(spark, sf_dir, "batch-incremental"), "sales_fact")


class Lost(RuntimeError):
    """The failure that ``batch_crash_replay`` brings about."""


def crashing_loads(spark: SparkSession, inputs: tuple[DataFrame, DataFrame, DataFrame], root: str, **options) -> int:
    """Run one load again and again, each time lost inside the next of its writes (the files of that
    write are there, some of its rows missing), until a run gets through. Returns the lost runs."""
    lost = 0
    while True:
        left = lost

        def on_write(table: str, df: DataFrame, save: Callable[[DataFrame], None]) -> None:
            nonlocal left
            if not left:
                save(df.limit(1))
                raise Lost(table)
            left -= 1
            save(df)

        try:
            _load(spark, inputs, root, on_write=on_write, **options)
            return lost
        except Lost:
            lost += 1


def batch_crash_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incremental load, lost inside each of its writes in turn before it gets through."""
    root = scratch_path(spark, "batch-crash")
    _load(spark, fx.batch_inputs(spark, sf_dir, 1), root)
    crashing_loads(spark, fx.batch_inputs(spark, sf_dir, 2), root, day=1, lookback=_LOOKBACK)
    return batch.published(spark, root, "sales_fact")


def batch_late_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second delivery with nothing but late sales, all before the stored mark."""
    root = scratch_path(spark, "batch-late")
    _load(spark, fx.late_inputs(spark, sf_dir, 1), root)
    outcome = _load(spark, fx.late_inputs(spark, sf_dir, 2), root, day=1, lookback=2 * _LOOKBACK)
    if outcome.decision != control.INCREMENTAL:
        raise AssertionError(f"late sales must be loaded, got {outcome.decision}")
    return batch.published(spark, root, "sales_fact")


def batch_zoned_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The marks of two loads whose timestamps have a zone, as wall clocks of the session's zone."""
    root = scratch_path(spark, "batch-zoned")
    for run in (1, 2):
        emp, sales, cities = fx.batch_inputs(spark, sf_dir, run)
        zoned = sales.withColumn("transacted_at", F.col("transacted_at").cast("timestamp"))
        _load(spark, (emp, zoned, cities), root, day=run - 1, lookback=_LOOKBACK)
    return Store(spark, root).control().select("mark_key", "mark_value", "seq")


def batch_email_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that identifies people by e-mail: every id of the key map with its number of sales."""
    root = scratch_path(spark, "batch-email")
    _load(spark, fx.batch_inputs(spark, sf_dir, 0), root, natural_key=["email"])
    sold = batch.published(spark, root, "sales_fact").groupBy("emp_id").agg(F.count(F.lit(1)).alias("n_sales"))
    return batch.published(spark, root, "key_map").join(sold, "emp_id", "full_outer").select("emp_id", "email", "n_sales")


def batch_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files to the star schema; returns the audit, unparsable lines included."""
    root = scratch_path(spark, "batch-csv")
    paths = fx.csv_inputs(spark, sf_dir, f"{root}/in")
    batch.run_batch_from(spark, paths, f"{root}/out", fx.AS_OF, fmt="csv")
    return batch.published(spark, f"{root}/out", "audit")


# ---------------------------------------------------------------- over time and over groups


def _money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


def fact_employee_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The employee version that was valid at each sale, from the type 2 dimension with its history (T12). A
    version holds from its start date until its end date."""
    history = _scd2(spark, sf_dir).drop("change_type")
    sold = fx.dated_sales(spark, sf_dir)
    return temporal.as_of_join(
        sold, history, ["emp_id"], "sold_at", "effective_start_date", ["effective_start_date", "job_title", "salary", "is_current"], until="effective_end_date"
    )


def retailer_moving_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales and amount of each retailer in the 30 days up to each of their sales."""
    found = temporal.moving_sums(fx.sales(spark, sf_dir), ["retailer_id"], "transacted_at", _money("amount"), "30 days")
    return found.select("retailer_id", "transacted_at", "n", F.col("total").cast("double").alias("total"))


def retailer_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of each retailer, grouped where none is more than 45 days behind the one before."""
    found = temporal.sessions(fx.sales(spark, sf_dir), ["retailer_id"], "transacted_at", "45 days", _money("amount"))
    return found.select("retailer_id", "start", "last", "n", F.col("total").cast("double").alias("total"))


def sales_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the sales by year, month, country and city, and over each of them; a null city is a sale
    without one, a total has its bit in ``grouping``."""
    cities_ = dims.city_dim(fx.cities(spark, sf_dir)).select("city_id", "city", "country")
    rows = facts.add_year_month(fx.sales(spark, sf_dir)).join(cities_, "city_id", "left")
    found = totals.grouped_totals(rows, ["year", "month", "country", "city"], _money("amount"))
    return found.withColumn("total", F.col("total").cast("double"))


def sales_price_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and amount of the sales in each price band; bands overlap, some are open, some hold nothing."""
    sold = fx.sales(spark, sf_dir).select("trx_id", "amount")
    found = bands.range_join(sold, fx.price_bands(spark, sf_dir), "amount", "lower", "upper", 10_000.0, sums={"total": _money("amount")})
    sums = found.groupBy("band_id").agg(F.sum("n").alias("n"), F.sum("total").cast("double").alias("total"))
    return fx.price_bands(spark, sf_dir).join(sums, "band_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def fact_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published fact of a first load against the stored state of the source: rows that one of them has
    and the other has not, or less often."""
    columns = ["transacted_at", "trx_id", "retailer_id", "description", "amount", "city_id"]
    root = scratch_path(spark, "reconciliation")
    _load(spark, fx.batch_inputs(spark, sf_dir, 0), root)
    found = bands.bag_difference(batch.published(spark, root, "sales_fact"), fx.sales_before(spark, sf_dir), columns)
    return found.withColumnsRenamed({"n_left": "in_fact", "n_right": "in_source"})


def fact_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct retailers and the median amount by year, from sketches stored by month: the first delivery
    writes them all, the second renews those of the months that its rows change. Returned are the exact values
    and whether the estimates are within their bounds (three standard errors, the rank error)."""
    root, parts = scratch_path(spark, "sketches"), ["year", "month"]
    dated = lambda df: facts.add_year_month(df).select("trx_id", "retailer_id", "amount", *parts)
    first = dated(fx.sales_before(spark, sf_dir).filter(F.col("trx_id") < 1_000_000))
    whole = dated(fx.sales(spark, sf_dir))
    made = lambda rows: sketches.partition_sketches(rows, parts, "retailer_id", "amount")
    run = Store(spark, root).begin()
    run.replace("sketches", made(first), parts)
    run.commit("sketches")
    run = Store(spark, root).begin()
    changed = bands.bag_difference(first, whole, ["trx_id", "retailer_id", "amount", *parts]).select(*parts).distinct()
    touched = run.work(changed, "touched")
    same = F.broadcast(touched.withColumnsRenamed({c: f"t_{c}" for c in parts}))
    renewed = whole.join(same, [whole[c].eqNullSafe(same[f"t_{c}"]) for c in parts], "left_semi")
    run.rewrite("sketches", made(renewed), touched, parts)
    run.commit("sketches")
    about = sketches.estimates(sketches.merged_sketches(Store(spark, root).read("sketches"), ["year"]))
    median = F.col("about_quantiles")[0]
    about = about.select(F.struct("year").alias("k"), F.col("n").alias("about_n"), "about_distinct", median.alias("median"))
    rows = whole.select(F.struct("year").alias("k"), "retailer_id", "amount").join(about, "k")
    exact = rows.groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("retailer_id").alias("retailers"), F.first("about_n").alias("about_n"),
        F.first("about_distinct").alias("about_distinct"), (F.count_if(F.col("amount") <= F.col("median")) / F.count(F.lit(1))).alias("upto"),
        (F.count_if(F.col("amount") < F.col("median")) / F.count(F.lit(1))).alias("below"),
    )
    near = F.abs(F.col("about_distinct") - F.col("retailers")) <= F.ceil(3 * sketches.HLL_ERROR * F.col("retailers"))
    # the asked rank is within the error of those that the found value covers
    ranked = (F.col("below") <= 0.5 + sketches.KLL_RANK_ERROR) & (F.col("upto") >= 0.5 - sketches.KLL_RANK_ERROR)
    return exact.select("k.year", "n", "retailers", (F.col("about_n") == F.col("n")).alias("n_renewed"), near.alias("distinct_within"), ranked.alias("median_within"))


def source_variant_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales from JSON documents whose fields drift: typed columns, and what did not fit."""
    return variants.typed_sales(fx.json_sales(spark, sf_dir), "doc").withColumn("amount", F.col("amount").cast("double"))


# ---------------------------------------------------------------- streaming form (slice 6)


def stream_scd1_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The type 1 merge of ``scd1_merge``, fed as a file stream in several micro-batches."""
    from starloom.streaming.merge_stream import stream_upsert

    root = scratch_path(spark, "stream")
    run = Store(spark, f"{root}/out").begin()
    run.replace("sales_fact", _scd1_side(fx.sales_before(spark, sf_dir)), schemas.SALES_FACT_PARTITIONS)
    run.commit("stored")
    incoming = fx.sales_after(spark, sf_dir)
    # the delivery arrives as 8 files in event-time ranges, two files per micro-batch, so a
    # micro-batch touches (and rewrites) only the months it carries
    write_table(incoming.repartitionByRange(8, "transacted_at"), f"{root}/incoming", rebalance=False)
    query = stream_upsert(
        spark,
        f"{root}/incoming",
        incoming.schema,
        f"{root}/out",
        f"{root}/_stream_checkpoint",
        prepare=_scd1_side,
        max_files_per_trigger=2,
    )
    query.awaitTermination()
    return batch.published(spark, f"{root}/out", "sales_fact")


def _delivered(frames: dict[str, DataFrame], root: str, start: Callable[[], StreamingQuery]) -> StreamingQuery:
    """Deliver ``frames`` (with a column ``delivery``) part by part into the folders of their names; after
    each part the query goes on from its checkpoint. Returns the last run."""
    query = None
    for n in range(len(fx.DELIVERIES)):
        for name, rows in frames.items():
            write_table(rows.filter(F.col("delivery") == n).drop("delivery"), f"{root}/{name}", mode=WriteMode.APPEND, rebalance=False)
        query = start()
        query.awaitTermination()
    return query


def stream_city_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales per city and hour from a stream in four deliveries, for all hours closed by its end. Some sales
    of the first delivery's time come with the last, behind the watermark: they are counted as late."""
    root = scratch_path(spark, "stream-hourly")
    rows = fx.timed_sales(spark, sf_dir)
    in_time = fx.delivery_of(F.col("sold_at"))
    late = (F.col("trx_id") % 9 == 0) & (in_time == 0)
    frame = rows.withColumn("delivery", F.when(late, len(fx.DELIVERIES) - 1).otherwise(in_time))
    amount, emitted = F.col("amount"), f"{root}/out"

    def start() -> StreamingQuery:
        stream = windows.arriving(spark, f"{root}/sales", rows.schema)
        return windows.appended(windows.window_totals(stream, ["city_id"], "sold_at", amount, "2 days"), emitted, f"{root}/checkpoint")

    _delivered({"sales": frame}, root, start)
    source = read_table(spark, f"{root}/sales", schema=rows.schema)
    closed = F.lit(source.agg(F.max("sold_at") - F.expr("interval 2 days")).first()[0])
    found = windows.late_totals(source, read_table(spark, emitted), ["city_id"], "sold_at", amount, closed)
    kinds = {"start": "timestamp_ntz", "end": "timestamp_ntz", "total": "double", "total_late": "double"}
    return found.withColumns({c: F.col(c).cast(k) for c, k in kinds.items()})


def stream_first_sale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sale from a stream in which sales of a delivery's last 30 days come again with the next."""
    root = scratch_path(spark, "stream-first")
    rows = fx.timed_sales(spark, sf_dir)
    n = fx.delivery_of(F.col("sold_at"))
    again = (F.col("trx_id") % 3 != 0) & (fx.delivery_of(F.col("sold_at") + F.expr("interval 30 days")) == n + 1)
    frame = rows.withColumn("delivery", F.explode(F.when(again, F.array(n, n, n + 1)).otherwise(F.array(n))))

    def start() -> StreamingQuery:
        stream = windows.arriving(spark, f"{root}/sales", rows.schema)
        return windows.appended(windows.first_rows(stream, ["trx_id"], "sold_at", "60 days"), f"{root}/out", f"{root}/checkpoint")

    _delivered({"sales": frame}, root, start)
    found = read_table(spark, f"{root}/out")
    return found.withColumns({"sold_at": F.col("sold_at").cast("timestamp_ntz"), "amount": F.col("amount").cast("double")})


def stream_sale_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales and their corrections within a week, as two streams that are joined as they arrive."""
    root = scratch_path(spark, "stream-corrections")
    sold = fx.timed_sales(spark, sf_dir)
    later = F.make_dt_interval(days=F.col("trx_id") % 11)
    changed = sold.filter(F.col("trx_id") % 4 == 0).select("trx_id", (F.col("sold_at") + later).alias("changed_at"), (F.col("amount") + 1).cast("decimal(18,2)").alias("new_amount"))
    frames = {
        "sales": sold.withColumn("delivery", fx.delivery_of(F.col("sold_at"))), "changes": changed.withColumn("delivery", fx.delivery_of(F.col("changed_at"))),
    }

    def start() -> StreamingQuery:
        left, right = windows.arriving(spark, f"{root}/sales", sold.schema), windows.arriving(spark, f"{root}/changes", changed.schema)
        joined = windows.corrections(left, right, "trx_id", "sold_at", "changed_at", "7 days", "3 days")
        return windows.appended(joined, f"{root}/out", f"{root}/checkpoint")

    _delivered(frames, root, start)
    found = read_table(spark, f"{root}/out")
    kinds = {"sold_at": "timestamp_ntz", "changed_at": "timestamp_ntz", "amount": "double", "new_amount": "double"}
    return found.withColumns({c: F.col(c).cast(k) for c, k in kinds.items()})


def batch_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit CSV of a first load, read back."""
    root = scratch_path(spark, "batch-audit")
    _load(spark, fx.batch_inputs(spark, sf_dir, 0), root)
    return batch.published(spark, root, "audit")


def batch_employee_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employee dimension after two loads: key map ids, type 2 versions."""
    return batch.published(spark, _two_loads(spark, sf_dir, "batch-employees"), "employee_dim")


def batch_date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date dimension after two loads: stored dates kept, slice dates added."""
    return batch.published(spark, _two_loads(spark, sf_dir, "batch-dates"), "date_dim")


def batch_rerun_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same delivery loaded twice: the second run skips and commits no mark."""
    root = scratch_path(spark, "batch-rerun")
    inputs = fx.batch_inputs(spark, sf_dir, 0)
    _load(spark, inputs, root)
    outcome = _load(spark, inputs, root)
    if outcome.decision != control.SKIP:
        raise AssertionError(f"a repeated delivery must be skipped, got {outcome.decision}")
    return Store(spark, root).control().select("mark_key", "mark_value", "seq")


QUERIES: dict[str, Query] = {
    "source_csv_roundtrip": _roundtrip("csv"),
    "source_json_roundtrip": _roundtrip("json"),
    "source_parquet_roundtrip": _roundtrip("parquet"),
    "write_modes_partition_overwrite": write_modes_partition_overwrite,
    "schema_check_report": schema_check_report,
    "clean_employees": clean_employees,
    "email_flag": email_flag,
    "employee_rank": employee_rank,
    "employee_chain": employee_chain,
    "valid_employees": valid_employees,
    "bad_employee_audit": bad_employee_audit,
    "quality_counts": quality_counts,
    "employee_rules_valid": employee_rules_valid,
    "employee_rules_bad": employee_rules_bad,
    "sales_city_enriched": sales_city_enriched,
    "sales_city_left": sales_city_left,
    "sales_city_orphans": sales_city_orphans,
    "city_dim": city_dim,
    "employee_dim_ids": employee_dim_ids,
    "sales_fact_assigned": sales_fact_assigned,
    "date_dim": date_dim,
    "sales_max_date": sales_max_date,
    "sales_year_month": sales_year_month,
    "sales_staging": sales_staging,
    "employee_staging": employee_staging,
    "scd1_merge": scd1_merge,
    "scd1_change_types": scd1_change_types,
    "scd1_snapshot": scd1_snapshot,
    "scd1_strict_merge": scd1_strict_merge,
    "scd1_merge_null_keys": scd1_merge_null_keys,
    "scd2_merge": scd2_merge,
    "scd2_merge_null_keys": scd2_merge_null_keys,
    "scd2_current": scd2_current,
    "watermark_latest": watermark_latest,
    "batch_decision": batch_decision,
    "incremental_slice": incremental_slice,
    "batch_first_load": batch_first_load,
    "batch_incremental": batch_incremental,
    "batch_crash_replay": batch_crash_replay,
    "batch_late_delivery": batch_late_delivery,
    "batch_zoned_timestamps": batch_zoned_timestamps,
    "batch_email_key": batch_email_key,
    "batch_from_csv": batch_from_csv,
    "fact_employee_as_of": fact_employee_as_of,
    "retailer_moving_sums": retailer_moving_sums,
    "retailer_sessions": retailer_sessions,
    "sales_cube": sales_cube,
    "sales_price_band": sales_price_band,
    "fact_reconciliation": fact_reconciliation,
    "fact_sketches": fact_sketches,
    "source_variant_sales": source_variant_sales,
    "stream_scd1_merge": stream_scd1_merge,
    "stream_city_hourly": stream_city_hourly,
    "stream_first_sale": stream_first_sale,
    "stream_sale_corrections": stream_sale_corrections,
    "batch_audit": batch_audit,
    "batch_employee_dim": batch_employee_dim,
    "batch_date_dim": batch_date_dim,
    "batch_rerun_control": batch_rerun_control,
}
