"""Schema checks and employee data-quality rules (inventory V1-V7, S10).

Split of the employee input (V4): one ranking per business key, materialised once, from which all
follows row by row:

* valid  = rank 1 and a valid e-mail. The e-mail is part of the key, so a key group is all valid or
  all invalid.
* audit  = every other row, with all its reasons.
* counts = one aggregate over the ranking.

valid + audit = input, row for row, also for null e-mails (reason ``email_null``) and for any
tie-breakers, because no row is ranked twice. The ranking spreads a key that holds a third of all
rows, or that many identical rows, over tasks (``functions.ranking``).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starloom.functions.dates import reached_age
from starloom.functions.ranking import distributed_row_number, sort_spec
from starloom.schemas import EMPLOYEE_KEY

# Fixed value: e-mail pattern (unanchored, so "a b@c.d e" passes).
EMAIL_PATTERN = r".+@.+\..+"

# Audit reason codes.
REASON_EMAIL_NULL = "email_null"
REASON_EMAIL_INVALID = "email_invalid"
REASON_DUPLICATE = "duplicate"
REASON_CORRUPT = "corrupt_record"

_RANK = "__rank"


def default_order() -> list[Column]:
    """Default dedup preference: highest salary first, nulls last."""
    return [F.col("salary").desc_nulls_last()]


# ---------------------------------------------------------------- V1 schema checks


def _expected_fields(expected) -> dict:
    if isinstance(expected, StructType):
        return {f.name: f for f in expected.fields}
    return {name: None for name in expected}


def schema_problems(df: DataFrame, expected, strict_types: bool = False) -> list[dict]:
    """Missing columns and (with ``strict_types``) type mismatches, reported together."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for name, field in _expected_fields(expected).items():
        if name not in actual:
            problems.append({"column": name, "problem": "missing", "expected": field and field.dataType.simpleString(), "actual": None})
        elif strict_types and field is not None and actual[name] != field.dataType:
            problems.append(
                {"column": name, "problem": "type", "expected": field.dataType.simpleString(), "actual": actual[name].simpleString()}
            )
    return problems


def check_schema(df: DataFrame, expected, strict_types: bool = False) -> DataFrame:
    """Raise ``ValueError`` listing every missing (and mismatched) column; extras are allowed."""
    problems = schema_problems(df, expected, strict_types)
    if problems:
        raise ValueError(f"schema check failed: {problems}")
    return df


def schema_report(df: DataFrame, expected: StructType, table: str) -> DataFrame:
    """One row per declared column: types, presence and the count of nulls in the data.

    Declared nullability is not enforced by Spark readers; ``null_count`` on a column declared
    NOT NULL is the number of violating rows. The null counts come from a single aggregation.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    present = [f for f in expected.fields if f.name in actual]
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(f.name).isNull()).alias(f"__n{i}") for i, f in enumerate(present)],
    )
    rows = []
    for pos, f in enumerate(expected.fields):
        if f.name in actual:
            i = present.index(f)
            null_count = F.col(f"__n{i}")
            actual_type = F.lit(actual[f.name].simpleString())
        else:
            null_count = F.lit(None).cast("bigint")
            actual_type = F.lit(None).cast("string")
        rows.append(
            F.struct(
                F.lit(pos + 1).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("expected_type"),
                actual_type.alias("actual_type"),
                F.lit(f.nullable).alias("declared_nullable"),
                null_count.alias("null_count"),
            )
        )
    report = counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return report.select(
        F.lit(table).alias("table_name"),
        "position",
        "column_name",
        "expected_type",
        "actual_type",
        F.col("actual_type").isNotNull().alias("present"),
        (F.col("actual_type") == F.col("expected_type")).alias("type_matches"),
        "declared_nullable",
        "null_count",
        (F.col("declared_nullable") | (F.coalesce(F.col("null_count"), F.lit(0)) == 0)).alias("nullability_ok"),
    )


# ---------------------------------------------------------------- V7, V2, V3


def clean_employees(df: DataFrame) -> DataFrame:
    """Trim first and last names; lower-case and trim the e-mail."""
    return (
        df.withColumn("first_name", F.trim("first_name"))
        .withColumn("last_name", F.trim("last_name"))
        .withColumn("email", F.lower(F.trim("email")))
    )


def email_is_valid(col: str | Column = "email") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.rlike(EMAIL_PATTERN)


def flag_email(df: DataFrame, col: str = "email", out: str = "is_valid_email") -> DataFrame:
    """Add the e-mail validity flag; a null e-mail gives a null flag."""
    return df.withColumn(out, email_is_valid(col))


def dedup_order(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None, tie_breakers: Sequence[str] | None) -> list[Column]:
    """The preference plus tie-breakers; by default every other column, so the order is total."""
    if order is None:
        order = default_order()
    if tie_breakers is None:
        tie_breakers = [c for c in df.columns if c not in keys]
    return list(order) + sort_spec(tie_breakers)


def rank_employees(
    df: DataFrame,
    keys: Sequence[str] = EMPLOYEE_KEY,
    order: Sequence[Column] | None = None,
    tie_breakers: Sequence[str] | None = None,
    out: str = "row_num",
) -> DataFrame:
    """V3: ``row_num`` = position of the row in its business-key group (1 = kept)."""
    ranked = distributed_row_number(df, keys, dedup_order(df, keys, order, tie_breakers), out=out)
    return ranked.withColumn(out, F.col(out).cast("int"))


def survivors(
    df: DataFrame,
    keys: Sequence[str] = EMPLOYEE_KEY,
    order: Sequence[Column] | None = None,
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """One row per business key: the first by the dedup order (top-1 window, partial limit)."""
    w = Window.partitionBy(*keys).orderBy(*dedup_order(df, keys, order, tie_breakers))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


# ---------------------------------------------------------------- V4, S10


@dataclass
class QualitySplit:
    ranked: DataFrame  # materialised: the input and ``__rank``
    email_col: str = "email"

    @property
    def _columns(self) -> list[str]:
        return [c for c in self.ranked.columns if c != _RANK]

    def _passed(self) -> Column:
        return (F.col(_RANK) == 1) & F.coalesce(email_is_valid(self.email_col), F.lit(False))

    @property
    def valid(self) -> DataFrame:
        return self.ranked.filter(self._passed()).select(*self._columns)

    @property
    def audit(self) -> DataFrame:
        reasons = _reasons(F.col(self.email_col), F.col(_RANK) > 1).alias("reasons")
        return self.ranked.filter(~self._passed()).select(*self._columns, reasons)

    def counts(self) -> DataFrame:
        """input / valid / bad and the three reason counts, one row, one job."""
        email, ok = F.col(self.email_col), email_is_valid(self.email_col)
        return self.ranked.agg(
            F.count(F.lit(1)).alias("input_rows"),
            F.count_if(self._passed()).alias("valid_rows"),
            F.count_if(~self._passed()).alias("bad_rows"),
            F.count_if(email.isNull()).alias("email_null"),
            F.count_if(email.isNotNull() & ~ok).alias("email_invalid"),
            F.count_if(F.col(_RANK) > 1).alias("duplicates"),
        )


def _reasons(email: Column, duplicate: Column) -> Column:
    return F.filter(
        F.array(
            F.when(email.isNull(), F.lit(REASON_EMAIL_NULL)),
            F.when(email.isNotNull() & ~email_is_valid(email), F.lit(REASON_EMAIL_INVALID)),
            F.when(duplicate, F.lit(REASON_DUPLICATE)),
        ),
        lambda r: r.isNotNull(),
    )


def split_employees(
    df: DataFrame,
    keys: Sequence[str] = EMPLOYEE_KEY,
    order: Sequence[Column] | None = None,
    tie_breakers: Sequence[str] | None = None,
    email_col: str = "email",
) -> QualitySplit:
    """V4: valid employees (deduplicated, valid e-mail) and the audit of every other row.

    Runs the ranking when called; the input is scanned once."""
    ranked = distributed_row_number(df, keys, dedup_order(df, keys, order, tie_breakers), out=_RANK)
    return QualitySplit(ranked.checkpoint(eager=True), email_col)


def valid_employees(
    df: DataFrame,
    keys: Sequence[str] = EMPLOYEE_KEY,
    order: Sequence[Column] | None = None,
    tie_breakers: Sequence[str] | None = None,
    email_col: str = "email",
) -> DataFrame:
    """The valid side of the split alone, lazily: a top-1 window with a partial limit before its shuffle
    instead of a full ranking. The order must be total; where the audit is needed too, take both from
    ``split_employees``."""
    return survivors(df, keys, order, tie_breakers).filter(email_is_valid(email_col))


def audit_for_csv(audit: DataFrame) -> DataFrame:
    """CSV holds no arrays: reasons as one comma-separated field."""
    return audit.withColumn("reasons", F.array_join("reasons", ","))


# ---------------------------------------------------------------- V5


@dataclass
class RuleSplit:
    valid: DataFrame
    bad: DataFrame


def employee_rules(df: DataFrame, as_of: dt.date | str, min_age: int = 18, email_col: str = "email") -> RuleSplit:
    """V5 rule set with a total split.

    valid = salary > 0 AND e-mail present and valid AND ``min_age`` reached by ``as_of``;
    bad   = NOT coalesce(valid, false), so a null salary or dob is bad, never lost.
    """
    email = F.col(email_col)
    rule = (
        (F.col("salary") > 0)
        & email.isNotNull()
        & email_is_valid(email)
        & reached_age("dob", min_age, as_of)
    )
    passed = F.coalesce(rule, F.lit(False))
    return RuleSplit(valid=df.filter(passed), bad=df.filter(~passed))


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
