"""Oracle SQL: an independent DuckDB formulation of every registered query.

The oracle sees only the raw driver tables as views, so each text starts with the fixture
derivations it needs as CTEs. Type casts make both engines return the same types
(DuckDB date parts and row numbers are BIGINT, Spark's are INT).
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixture CTEs

FX = {
    "fx_employees": """
fx_employees as (
  select c_custkey as src_id,
         case when c_custkey % 3 = 0 then ' Ann ' when c_custkey % 3 = 1 then 'Bo' else 'Cy' end as first_name,
         case when c_custkey % 20 = 0 and c_custkey % 3 = 0 then '' else substr(c_name, 10) end as last_name,
         case when c_custkey % 20 = 0 and c_custkey % 3 = 0
              then c_mktsegment || chr(10) || '"a, b"' || chr(13) || chr(92) else c_mktsegment end as job_title,
         case when c_custkey % 101 = 0 then null
              else cast(date '1960-01-01' + cast((c_custkey * 37) % 20000 as integer) as date) end as dob,
         case when c_custkey % 40 = 0 then null
              when c_custkey % 40 = 1 then 'bad'
              when c_custkey % 40 = 2 then 'U2@EX.COM'
              else 'u' || cast(c_custkey % 40 as varchar) || '@ex.com' end as email,
         '555' || cast(c_custkey % 40 as varchar) as phone,
         case when c_custkey % 97 = 0 then null else cast(floor(c_acctbal) as integer) end as salary,
         c_nationkey as department_id
  from customer)""",
    "fx_cities": """
fx_cities as (
  select n_nationkey as city_id, n_name as city, r_name as state,
         case when n_nationkey % 4 = 0 then null else substr(r_name, 1, 2) end as state_abv,
         r_name as country
  from nation join region on n_regionkey = r_regionkey
  union all
  select n_nationkey, n_name || '_DUP', r_name, substr(r_name, 1, 2), r_name
  from nation join region on n_regionkey = r_regionkey where n_nationkey % 5 = 0)""",
    "fx_sales": """
fx_sales as (
  select case when o_orderkey % 503 = 0 then null else o_orderdate end as transacted_at,
         cast(o_orderkey as integer) as trx_id,
         cast(o_custkey as integer) as retailer_id,
         case when o_orderkey % 13 = 0 then null else o_orderpriority end as description,
         o_totalprice as amount,
         cast(o_custkey % 30 as integer) as city_id
  from orders)""",
    "fx_dated_sales": """
fx_dated_sales as (
  select cast(o_orderkey as integer) as trx_id, cast(o_custkey as integer) as emp_id,
         case when o_orderkey % 503 <> 0 then o_orderdate + interval 23 years + to_hours(cast(o_orderkey % 24 as integer)) end as sold_at
  from orders)""",
    "fx_timed_sales": """
fx_timed_sales as (
  select cast(o_orderkey as integer) as trx_id, cast(o_custkey % 30 as integer) as city_id,
         o_orderdate + to_hours(cast(o_orderkey % 24 as integer)) as sold_at, cast(o_totalprice as decimal(18,2)) as amount
  from orders)""",
    "fx_bands": """
fx_bands as (
  select s_suppkey as band_id, case when s_suppkey % 17 <> 0 then floor(s_acctbal * 40) end as lower,
         case when s_suppkey % 19 <> 0 then floor(s_acctbal * 40) + (s_suppkey % 20 - 1) * 1000.0 end as upper
  from supplier)""",
    "fx_sales_after": """
fx_sales_after as (select * from fx_sales where trx_id % 11 <> 0)""",
    "fx_sales_before": """
fx_sales_before as (
  select transacted_at, trx_id, retailer_id, description,
         case when trx_id % 7 = 0 then amount + 1 else amount end as amount, city_id
  from fx_sales where trx_id % 10 <> 0 or trx_id % 11 = 0
  union all
  select transacted_at, trx_id + 1000000, retailer_id, description, amount, city_id
  from fx_sales where trx_id % 50 = 0)""",
    "fx_batch_before": """
fx_batch_before as (
  select transacted_at, trx_id, retailer_id, description,
         case when trx_id % 7 = 0 then amount + 1 else amount end as amount, city_id
  from fx_sales
  where (trx_id % 10 <> 0 or trx_id % 11 = 0 or transacted_at < timestamp '2000-03-01')
    and (transacted_at is null or transacted_at < timestamp '2001-01-01')
  union all
  select transacted_at, trx_id + 1000000, retailer_id, description, amount, city_id
  from fx_sales where trx_id % 50 = 0 and (transacted_at is null or transacted_at < timestamp '2001-01-01'))""",
    "fx_batch_after": """
fx_batch_after as (select * from fx_sales where trx_id % 11 <> 0 or transacted_at >= timestamp '2001-01-01')""",
    "fx_emp_after": """
fx_emp_after as (
  select cast(src_id as integer) as emp_id, first_name, last_name, job_title, dob, email, phone, salary, department_id
  from fx_employees where src_id % 11 <> 0)""",
    "fx_emp_before": """
fx_emp_before as (
  select cast(src_id as integer) as emp_id, first_name, last_name, job_title, dob, email, phone,
         case when src_id % 7 = 0 then salary + 1 else salary end as salary, department_id,
         date '2024-01-01' as effective_start_date, cast(null as date) as effective_end_date, true as is_current
  from fx_employees where src_id % 10 <> 0 or src_id % 11 = 0
  union all
  select cast(src_id as integer), first_name, last_name, 'OLD', dob, email, phone, salary, department_id,
         date '2023-01-01', date '2024-01-01', false
  from fx_employees where src_id % 25 = 1)""",
    "fx_control": """
fx_control as (
  select 'last_Processed_date' as mark_key, max(transacted_at) as mark_value, cast(year(transacted_at) as bigint) as seq
  from fx_sales where transacted_at is not null and year(transacted_at) <= 2000
  group by year(transacted_at))""",
}

_DEPENDS = {
    "fx_sales_after": ["fx_sales"],
    "fx_sales_before": ["fx_sales"],
    "fx_batch_after": ["fx_sales"],
    "fx_batch_before": ["fx_sales"],
    "fx_emp_after": ["fx_employees"],
    "fx_emp_before": ["fx_employees"],
    "fx_control": ["fx_sales"],
}


def with_fixtures(names: list[str], body: str, extra: list[str] | None = None) -> str:
    """``with <fixture CTEs>, <extra CTEs> <body>``; dependencies are added first."""
    ordered: list[str] = []

    def add(n: str) -> None:
        for d in _DEPENDS.get(n, []):
            add(d)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        add(n)
    ctes = [FX[n].strip() for n in ordered] + [e.strip() for e in (extra or [])]
    return "with " + ",\n".join(ctes) + "\n" + body.strip()


EMAIL_OK = r"regexp_matches(email, '.+@.+\..+')"
EMP_COLS = "first_name, last_name, job_title, dob, email, phone, salary, department_id"
DEDUP_ORDER = "salary desc nulls last, src_id"

# ranked employees: row number per business key, preference then src_id
EMP_RANKED = f"""
emp_ranked as (
  select *, cast(row_number() over (partition by department_id, phone, email order by {DEDUP_ORDER}) as integer) as row_num
  from fx_employees)"""

EMP_VALID = f"""
emp_valid as (select src_id, {EMP_COLS} from emp_ranked where row_num = 1 and {EMAIL_OK})"""



EMP_COLS_Q = "src_id, " + EMP_COLS
AS_OF = "date '2024-06-01'"


def _hash(cols: list[str]) -> str:
    """sha2(concat_ws('||', ...), 256) with every field as text (nulls skipped)."""
    return "sha256(concat_ws('||', " + ", ".join(f"cast({c} as varchar)" for c in cols) + "))"


def _strict_hash(cols: list[str]) -> str:
    parts = [f"coalesce(cast(length(cast({c} as varchar)) as varchar) || ':' || cast({c} as varchar), '~')" for c in cols]
    return "sha256(concat_ws('|', " + ", ".join(parts) + "))"


SALES_HASH = ["retailer_id", "description", "amount", "city_id", "emp_id"]
EMP_HASH = ["first_name", "last_name", "job_title", "phone", "salary", "department_id"]
SALES_COLS = "transacted_at, trx_id, retailer_id, description, amount, city_id"
YEAR_MONTH = "cast(year(transacted_at) as integer) as year, cast(month(transacted_at) as integer) as month"


def murmur3_ctes(source: str, key: str, out: str) -> list[str]:
    """CTE chain adding ``spark_hash`` = Spark's hash(key) for an INT key (Murmur3 x86_32, seed 42)."""
    m = 4294967295
    steps = [
        f"case when {key} is null then null else cast({key} as bigint) & {m} end as __k0",
        f"cast((cast(__k0 as hugeint) * 3432918353) & {m} as bigint) as __k1",
        f"((__k1 << 15) | (__k1 >> 17)) & {m} as __k2",
        f"cast((cast(__k2 as hugeint) * 461845907) & {m} as bigint) as __k3",
        f"xor(cast(42 as bigint), __k3) as __h0",
        f"((__h0 << 13) | (__h0 >> 19)) & {m} as __h1",
        f"cast((cast(__h1 as hugeint) * 5 + 3864292196) & {m} as bigint) as __h2",
        f"xor(__h2, cast(4 as bigint)) as __h3",
        f"xor(__h3, __h3 >> 16) as __h4",
        f"cast((cast(__h4 as hugeint) * 2246822507) & {m} as bigint) as __h5",
        f"xor(__h5, __h5 >> 13) as __h6",
        f"cast((cast(__h6 as hugeint) * 3266489909) & {m} as bigint) as __h7",
        f"xor(__h7, __h7 >> 16) as __h8",
    ]
    ctes = []
    prev = source
    for i, step in enumerate(steps):
        name = f"{out}_m{i}"
        ctes.append(f"{name} as (select *, {step} from {prev})")
        prev = name
    ctes.append(
        f"{out} as (select * exclude (__k0, __k1, __k2, __k3, __h0, __h1, __h2, __h3, __h4, __h5, __h6, __h7, __h8), "
        f"case when {key} is null then 42 when __h8 >= 2147483648 then __h8 - 4294967296 else __h8 end as spark_hash "
        f"from {prev})"
    )
    return ctes


def _emp_id_expr(n: str) -> str:
    """T4: abs(hash) % n + 1, null for n = 0."""
    return f"case when {n} > 0 then cast(abs(spark_hash) % {n} + 1 as bigint) end"


# ---------------------------------------------------------------- sources and sinks


def roundtrip() -> str:
    return with_fixtures(["fx_sales"], f"select {SALES_COLS}, {YEAR_MONTH} from fx_sales")


def write_modes() -> str:
    body = f"""
select * from b where not coalesce(year = 1998 and month <= 6, false)
union all
select * from a where year = 1998 and month <= 6
union all
select * from a where transacted_at is null"""
    extra = [
        f"b as (select {SALES_COLS}, {YEAR_MONTH} from fx_sales_before)",
        f"a as (select {SALES_COLS}, {YEAR_MONTH} from fx_sales_after)",
    ]
    return with_fixtures(["fx_sales_before", "fx_sales_after"], body, extra)


# ---------------------------------------------------------------- quality

_DECLARED = {
    "employees": [
        ("first_name", "string", False), ("last_name", "string", False), ("job_title", "string", True),
        ("dob", "date", False), ("email", "string", True), ("phone", "string", True),
        ("salary", "int", True), ("department_id", "int", False),
    ],
    "sales": [
        ("transacted_at", "timestamp", False), ("trx_id", "int", True), ("retailer_id", "int", True),
        ("description", "string", True), ("amount", "double", True), ("city_id", "int", False),
    ],
    "cities": [
        ("city_id", "int", False), ("city", "string", False), ("state", "string", False),
        ("state_abv", "string", True), ("country", "string", False),
    ],
}
# types the fixture frames actually have
_ACTUAL = {"transacted_at": "timestamp_ntz"}
_SOURCE = {"employees": "fx_employees", "sales": "fx_sales", "cities": "fx_cities"}


def schema_report() -> str:
    selects = []
    for table, fields in _DECLARED.items():
        for pos, (name, typ, nullable) in enumerate(fields, start=1):
            actual = _ACTUAL.get(name, typ) if table == "sales" else typ
            nl = "true" if nullable else "false"
            selects.append(
                f"select '{table}' as table_name, cast({pos} as integer) as position, '{name}' as column_name, "
                f"'{typ}' as expected_type, '{actual}' as actual_type, true as present, "
                f"{'true' if actual == typ else 'false'} as type_matches, {nl} as declared_nullable, "
                f"count(*) filter (where {name} is null) as null_count, "
                f"({nl} or count(*) filter (where {name} is null) = 0) as nullability_ok from {_SOURCE[table]}"
            )
    return with_fixtures(["fx_employees", "fx_sales", "fx_cities"], "\nunion all\n".join(selects))


def clean_employees() -> str:
    return with_fixtures(
        ["fx_employees"],
        """select src_id, trim(first_name) as first_name, trim(last_name) as last_name, job_title, dob,
                  lower(trim(email)) as email, phone, salary, department_id from fx_employees""",
    )


def email_flag() -> str:
    return with_fixtures(["fx_employees"], f"select *, {EMAIL_OK} as is_valid_email from fx_employees")


def employee_rank() -> str:
    return with_fixtures(["fx_employees"], "select * from emp_ranked", [EMP_RANKED])


def employee_chain() -> str:
    body = f"""
select *, {EMAIL_OK} as is_valid_email,
       cast(row_number() over (partition by department_id, phone, email order by {DEDUP_ORDER}) as integer) as row_num
from (select src_id, trim(first_name) as first_name, trim(last_name) as last_name, job_title, dob,
             lower(trim(email)) as email, phone, salary, department_id from fx_employees)"""
    return with_fixtures(["fx_employees"], body)


def valid_employees() -> str:
    return with_fixtures(["fx_employees"], "select * from emp_valid", [EMP_RANKED, EMP_VALID])


def bad_employee_audit() -> str:
    body = f"""
select {EMP_COLS_Q},
       concat_ws(',', case when email is null then 'email_null' end,
                      case when email is not null and not {EMAIL_OK} then 'email_invalid' end,
                      case when row_num > 1 then 'duplicate' end) as reasons
from emp_ranked
where row_num > 1 or not coalesce({EMAIL_OK}, false)"""
    return with_fixtures(["fx_employees"], body, [EMP_RANKED])


def quality_counts() -> str:
    body = f"""
select count(*) as input_rows,
       count(*) filter (where row_num = 1 and coalesce({EMAIL_OK}, false)) as valid_rows,
       count(*) filter (where not (row_num = 1 and coalesce({EMAIL_OK}, false))) as bad_rows,
       count(*) filter (where email is null) as email_null,
       count(*) filter (where email is not null and not {EMAIL_OK}) as email_invalid,
       count(*) filter (where row_num > 1) as duplicates
from emp_ranked"""
    return with_fixtures(["fx_employees"], body, [EMP_RANKED])


_RULE = (
    f"coalesce(salary > 0 and email is not null and {EMAIL_OK} "
    f"and dob + to_months(216) <= {AS_OF}, false)"
)


def employee_rules(valid: bool) -> str:
    cond = _RULE if valid else f"not {_RULE}"
    return with_fixtures(["fx_employees"], f"select * from fx_employees where {cond}")


# ---------------------------------------------------------------- dimensions and facts

CITY_DIM = """
city_dim as (
  select city_id, city, state, state_abv, country from (
    select *, row_number() over (partition by city_id
                                 order by city nulls first, state nulls first, state_abv nulls first, country nulls first) as rn
    from fx_cities) where rn = 1)"""


def city_dim() -> str:
    return with_fixtures(["fx_cities"], "select * from city_dim", [CITY_DIM])


def sales_city(how: str) -> str:
    if how == "left":
        body = "select s.*, c.city, c.state, c.state_abv, c.country from fx_sales s left join city_dim c on s.city_id = c.city_id"
    elif how == "inner":
        body = "select s.*, c.city, c.state, c.state_abv, c.country from fx_sales s join city_dim c on s.city_id = c.city_id"
    else:
        body = "select s.* from fx_sales s where not exists (select 1 from city_dim c where c.city_id = s.city_id)"
    return with_fixtures(["fx_sales", "fx_cities"], body, [CITY_DIM])


EMP_IDS = """
emp_ids as (
  select cast(row_number() over (order by department_id nulls first, phone nulls first, email nulls first) as bigint) as emp_id, *
  from emp_valid)"""


def employee_dim_ids() -> str:
    return with_fixtures(["fx_employees"], "select * from emp_ids", [EMP_RANKED, EMP_VALID, EMP_IDS])


def _assigned_ctes() -> list[str]:
    return [EMP_RANKED, EMP_VALID, "emp_n as (select count(*) as n from emp_valid)"] + murmur3_ctes(
        "fx_sales", "trx_id", "sales_h"
    ) + [
        f"""sales_assigned as (
  select {SALES_COLS}, {_emp_id_expr('(select n from emp_n)')} as emp_id from sales_h)"""
    ]


def sales_fact_assigned() -> str:
    return with_fixtures(["fx_employees", "fx_sales"], "select * from sales_assigned", _assigned_ctes())


def sales_staging() -> str:
    body = f"select *, {_hash(SALES_HASH)} as record_hash, {_strict_hash(SALES_HASH)} as strict_hash from sales_assigned"
    return with_fixtures(["fx_employees", "fx_sales"], body, _assigned_ctes())


def employee_staging() -> str:
    body = f"""
select *, {_hash(EMP_HASH)} as record_hash, {AS_OF} as effective_start_date,
       cast(null as date) as effective_end_date, true as is_current
from emp_ids"""
    return with_fixtures(["fx_employees"], body, [EMP_RANKED, EMP_VALID, EMP_IDS])


def date_dim() -> str:
    body = """
select d as "date", cast(day(d) as integer) as day, cast(month(d) as integer) as month,
       cast(year(d) as integer) as year, cast(quarter(d) as integer) as quarter
from (select distinct cast(transacted_at as date) as d from fx_sales where transacted_at is not null)"""
    return with_fixtures(["fx_sales"], body)


def sales_max_date() -> str:
    body = """
select max_ts, cast(max_ts as date) as max_date,
       cast(cast(max_ts as date) as timestamp) + interval '86399999999 microseconds' as day_mark
from (select max(transacted_at) as max_ts from fx_sales)"""
    return with_fixtures(["fx_sales"], body)


def sales_year_month() -> str:
    return with_fixtures(["fx_sales"], f"select *, {YEAR_MONTH} from fx_sales")


# ---------------------------------------------------------------- merges

_SCD1_SIDES = [
    f"tgt as (select *, {_hash(SALES_HASH)} as record_hash from (select {SALES_COLS}, cast(1 as bigint) as emp_id, {YEAR_MONTH} from fx_sales_before))",
    f"stg as (select *, {_hash(SALES_HASH)} as record_hash from (select {SALES_COLS}, cast(1 as bigint) as emp_id, {YEAR_MONTH} from fx_sales_after))",
]
_UPDATED = ["retailer_id", "description", "amount", "city_id", "emp_id", "record_hash"]
_KEPT = ["transacted_at", "year", "month"]

SCD1_MERGED = (
    "merged as (select "
    + ", ".join(
        [f"case when t.trx_id is null then s.{c} else t.{c} end as {c}" for c in _KEPT]
        + ["coalesce(t.trx_id, s.trx_id) as trx_id"]
        + [
            f"case when t.trx_id is null or (s.trx_id is not null and s.record_hash <> t.record_hash) then s.{c} else t.{c} end as {c}"
            for c in _UPDATED
        ]
        + [
            "case when t.trx_id is null then 'insert' when s.trx_id is null then 'retained' "
            "when s.record_hash = t.record_hash then 'unchanged' else 'update' end as change_type"
        ]
    )
    + " from stg s full outer join tgt t on s.trx_id = t.trx_id)"
)


def scd1_merge() -> str:
    return with_fixtures(["fx_sales_before", "fx_sales_after"], "select * exclude (change_type) from merged", _SCD1_SIDES + [SCD1_MERGED])


def scd1_strict_merge() -> str:
    sides = [side.replace("as record_hash from", f"as record_hash, {_strict_hash(SALES_HASH)} as strict_hash from", 1) for side in _SCD1_SIDES]
    pick = "case when t.trx_id is null or (s.trx_id is not null and s.strict_hash <> t.strict_hash) then s.strict_hash else t.strict_hash end as strict_hash"
    merged = SCD1_MERGED.replace("s.record_hash <> t.record_hash", "s.strict_hash <> t.strict_hash")
    merged = merged.replace("when s.record_hash = t.record_hash", "when s.strict_hash = t.strict_hash").replace("merged as (select ", f"merged as (select {pick}, ")
    return with_fixtures(["fx_sales_before", "fx_sales_after"], "select * from merged", sides + [merged])


def scd1_merge_null_keys() -> str:
    sides = [_SCD1_SIDES[0].replace("tgt as", "whole as"), _SCD1_SIDES[1], "tgt as (select * from whole where trx_id % 50 <> 1)"]
    body = """
select * from merged
union all by name
select * replace (cast(null as integer) as trx_id), 'retained' as change_type from whole where trx_id % 50 = 1"""
    return with_fixtures(["fx_sales_before", "fx_sales_after"], body, sides + [SCD1_MERGED])


def scd1_change_types() -> str:
    return with_fixtures(
        ["fx_sales_before", "fx_sales_after"],
        "select change_type, count(*) as n_rows from merged group by change_type",
        _SCD1_SIDES + [SCD1_MERGED],
    )


def scd1_snapshot() -> str:
    body = """
select s.*, case when t.trx_id is null then 'insert' when s.record_hash = t.record_hash then 'unchanged' else 'update' end as change_type
from stg s left join tgt t on s.trx_id = t.trx_id"""
    return with_fixtures(["fx_sales_before", "fx_sales_after"], body, _SCD1_SIDES)


EMP_ATTRS = "emp_id, first_name, last_name, job_title, dob, email, phone, salary, department_id, record_hash"
_SCD2_SIDES = [
    f"stg as (select emp_id, {EMP_COLS}, {_hash(EMP_HASH)} as record_hash from fx_emp_after)",
    f"tgt as (select emp_id, {EMP_COLS}, {_hash(EMP_HASH)} as record_hash, effective_start_date, effective_end_date, is_current from fx_emp_before)",
    "cur as (select * from tgt where is_current)",
]


def _t(cols: str, alias: str) -> str:
    return ", ".join(f"{alias}.{c.strip()}" for c in cols.split(","))


SCD2_TEMPLATE = """
select *, 'history' as change_type from tgt where not is_current
union all
select t.*, 'retained' from cur t where not exists (select 1 from stg s where s.emp_id = t.emp_id)
union all
select t.*, 'unchanged' from cur t join stg s on s.emp_id = t.emp_id where s.record_hash = t.record_hash
union all
select {_t(EMP_ATTRS, 't')}, t.effective_start_date, {AS_OF}, false, 'expired'
from cur t join stg s on s.emp_id = t.emp_id where s.record_hash <> t.record_hash and t.effective_start_date <> {AS_OF}
union all
select {_t(EMP_ATTRS, 's')}, {AS_OF}, cast(null as date), true, 'new_version'
from stg s join cur t on s.emp_id = t.emp_id where s.record_hash <> t.record_hash
union all
select s.*, {AS_OF}, cast(null as date), true, 'new' from stg s where not exists (select 1 from cur t where t.emp_id = s.emp_id)"""


def scd2_body(as_of: str) -> str:
    return SCD2_TEMPLATE.replace("{_t(EMP_ATTRS, 't')}", _t(EMP_ATTRS, "t")).replace(
        "{_t(EMP_ATTRS, 's')}", _t(EMP_ATTRS, "s")
    ).replace("{AS_OF}", as_of)


SCD2_BODY = scd2_body(AS_OF)


def scd2_merge() -> str:
    return with_fixtures(["fx_emp_before", "fx_emp_after"], f"select * from ({SCD2_BODY})", _SCD2_SIDES)


def scd2_merge_null_keys() -> str:
    body = f"""
select * from ({SCD2_BODY})
union all
select * replace (cast(null as integer) as emp_id), case when is_current then 'retained' else 'history' end from whole where emp_id % 20 = 1"""
    sides = [_SCD2_SIDES[0], _SCD2_SIDES[1].replace("tgt as", "whole as"), "tgt as (select * from whole where emp_id % 20 <> 1)", _SCD2_SIDES[2]]
    return with_fixtures(["fx_emp_before", "fx_emp_after"], body, sides)


def scd2_current() -> str:
    return with_fixtures(
        ["fx_emp_before", "fx_emp_after"], f"select * exclude (change_type) from ({SCD2_BODY}) where is_current", _SCD2_SIDES
    )


# ---------------------------------------------------------------- control

LATEST = "latest as (select mark_key, arg_max(mark_value, seq) as mark_value, max(seq) as seq from fx_control group by mark_key)"
STORED = "(select mark_value from latest where mark_key = 'last_Processed_date')"


def watermark_latest() -> str:
    return with_fixtures(["fx_control"], "select * from latest", [LATEST])


def batch_decision() -> str:
    body = f"""
select {STORED} as stored_mark, max(transacted_at) as batch_max,
       case when max(transacted_at) is null then 'skip'
            when {STORED} is null then 'first_load'
            when max(transacted_at) > {STORED} then 'incremental'
            else 'skip' end as decision
from fx_sales"""
    return with_fixtures(["fx_sales", "fx_control"], body, [LATEST])


def incremental_slice() -> str:
    return with_fixtures(["fx_sales", "fx_control"], f"select * from fx_sales where transacted_at is null or transacted_at > {STORED}", [LATEST])


# ---------------------------------------------------------------- the batch job


def _ranked_valid(prefix: str, source: str) -> list[str]:
    return [
        f"""{prefix}_ranked as (
  select *, row_number() over (partition by department_id, phone, email order by {DEDUP_ORDER}) as row_num from {source})""",
        f"{prefix}_valid as (select * from {prefix}_ranked where row_num = 1 and {EMAIL_OK})",
        f"{prefix}_n as (select count(*) as n from {prefix}_valid)",
    ]


def _first_load_ctes() -> list[str]:
    return (
        ["emp1 as (select * from fx_employees where src_id % 11 <> 0)"]
        + _ranked_valid("e1", "emp1")
        + ["s1 as (select * from fx_batch_before)"]
        + murmur3_ctes("s1", "trx_id", "s1_h")
        + [
            f"""f1 as (select *, {_hash(SALES_HASH)} as record_hash from (
  select {SALES_COLS}, {_emp_id_expr('(select n from e1_n)')} as emp_id, {YEAR_MONTH} from s1_h))"""
        ]
    )


def _whole_fact(source: str) -> list[str]:
    """The fact of one load of ``source`` with all employees."""
    return (
        _ranked_valid("e0", "fx_employees")
        + murmur3_ctes(source, "trx_id", "s0_h")
        + [
            f"""f0 as (select *, {_hash(SALES_HASH)} as record_hash from (
  select {SALES_COLS}, {_emp_id_expr('(select n from e0_n)')} as emp_id, {YEAR_MONTH} from s0_h))"""
        ]
    )


def batch_first_load() -> str:
    return with_fixtures(["fx_employees", "fx_sales"], "select * from f0", _whole_fact("fx_sales"))


def batch_late_delivery() -> str:
    return batch_first_load()


def batch_zoned_timestamps() -> str:
    body = """
select 'last_Processed_date' as mark_key, max(transacted_at) as mark_value, cast(1 as bigint) as seq
from fx_batch_before
union all
select 'last_Processed_date', max(transacted_at), cast(2 as bigint) from fx_batch_after"""
    return with_fixtures(["fx_batch_before", "fx_batch_after"], body)


def batch_email_key() -> str:
    ctes = _ranked_valid("e0", "fx_employees") + [
        f"people as (select * from (select *, row_number() over (partition by email order by {DEDUP_ORDER}) as n from e0_valid) where n = 1)",
        "people_n as (select count(*) as n from people)",
    ] + murmur3_ctes("fx_sales", "trx_id", "s0_h") + [
        f"sold as (select {_emp_id_expr('(select n from people_n)')} as emp_id, count(*) as n_sales from s0_h group by 1)",
        "ids as (select cast(row_number() over (order by email) as bigint) as emp_id, email from people)",
    ]
    return with_fixtures(["fx_employees", "fx_sales"], "select emp_id, email, n_sales from ids full outer join sold using (emp_id)", ctes)


def batch_from_csv() -> str:
    order = "salary desc nulls last, first_name nulls first, last_name nulls first, job_title nulls first, dob nulls first"
    body = f"""
select {EMP_COLS}, cast(null as varchar) as corrupt_record,
       concat_ws(',', case when email is null then 'email_null' end,
                      case when email is not null and not {EMAIL_OK} then 'email_invalid' end,
                      case when row_num > 1 then 'duplicate' end) as reasons
from (select *, row_number() over (partition by department_id, phone, email order by {order}) as row_num from fx_employees)
where row_num > 1 or not coalesce({EMAIL_OK}, false)
union all
select null, null, null, null, null, null, null, null,
       concat_ws(',', first_name, upper(last_name), job_title, 'not a date', email, phone, coalesce(cast(salary as varchar), ''), cast(department_id as varchar)),
       'corrupt_record'
from fx_employees where phone = '5557'"""
    return with_fixtures(["fx_employees"], body)


def batch_incremental() -> str:
    ctes = (
        _first_load_ctes()
        + _ranked_valid("e2", "fx_employees")
        + [
            "slice as (select * from fx_batch_after where transacted_at is null or transacted_at > (select max(transacted_at) from s1) - interval 365 days)"
        ]
        + murmur3_ctes("slice", "trx_id", "slice_h")
        + [
            f"""stg as (select *, {_hash(SALES_HASH)} as record_hash from (
  select sl.transacted_at, sl.trx_id, sl.retailer_id, sl.description, sl.amount, sl.city_id,
         coalesce(f1.emp_id, {_emp_id_expr('(select n from e2_n)')}) as emp_id,
         cast(year(sl.transacted_at) as integer) as year, cast(month(sl.transacted_at) as integer) as month
  from slice_h sl left join f1 on sl.trx_id = f1.trx_id))""",
            "tgt as (select * from f1)",
            SCD1_MERGED,
        ]
    )
    return with_fixtures(["fx_employees", "fx_batch_before", "fx_batch_after"], "select * exclude (change_type) from merged", ctes)


KEY_ORDER = "department_id nulls first, phone nulls first, email nulls first"
NULL_SAFE_KEY = (
    "{a}.department_id is not distinct from {b}.department_id and {a}.phone is not distinct from {b}.phone "
    "and {a}.email is not distinct from {b}.email"
)


def batch_audit() -> str:
    body = f"""
select {EMP_COLS_Q},
       concat_ws(',', case when email is null then 'email_null' end,
                      case when email is not null and not {EMAIL_OK} then 'email_invalid' end,
                      case when row_num > 1 then 'duplicate' end) as reasons
from e0_ranked
where row_num > 1 or not coalesce({EMAIL_OK}, false)"""
    return with_fixtures(["fx_employees"], body, _ranked_valid("e0", "fx_employees"))


def batch_employee_dim() -> str:
    ctes = (
        ["emp1 as (select * from fx_employees where src_id % 11 <> 0)"]
        + _ranked_valid("e1", "emp1")
        + _ranked_valid("e2", "fx_employees")
        + [
            f"ids1 as (select cast(row_number() over (order by {KEY_ORDER}) as bigint) as emp_id, * from e1_valid)",
            f"""tgt as (select emp_id, {EMP_COLS}, {_hash(EMP_HASH)} as record_hash, {AS_OF} as effective_start_date,
                cast(null as date) as effective_end_date, true as is_current from ids1)""",
            "cur as (select * from tgt where is_current)",
            f"""new_keys as (select department_id, phone, email from e2_valid v
                where not exists (select 1 from ids1 i where {NULL_SAFE_KEY.format(a='i', b='v')}))""",
            f"""key_map as (select department_id, phone, email, emp_id from ids1
                union all
                select department_id, phone, email,
                       (select max(emp_id) from ids1) + row_number() over (order by {KEY_ORDER}) from new_keys)""",
            f"""stg as (select m.emp_id, {_t(EMP_COLS, 'v')}, {_hash(['v.' + c for c in EMP_HASH])} as record_hash
                from e2_valid v join key_map m on {NULL_SAFE_KEY.format(a='m', b='v')})""",
        ]
    )
    next_day = "date '2024-06-02'"
    body = f"select * exclude (change_type) from ({scd2_body(next_day)})"
    return with_fixtures(["fx_employees"], body, ctes)


def batch_date_dim() -> str:
    body = """
select d as "date", cast(day(d) as integer) as day, cast(month(d) as integer) as month,
       cast(year(d) as integer) as year, cast(quarter(d) as integer) as quarter
from (select cast(transacted_at as date) as d from s1 where transacted_at is not null
      union
      select cast(transacted_at as date) from fx_batch_after
      where transacted_at > (select max(transacted_at) from s1) - interval 365 days)"""
    ctes = ["s1 as (select * from fx_batch_before)"]
    return with_fixtures(["fx_batch_before", "fx_batch_after"], body, ctes)


def batch_rerun_control() -> str:
    body = """
select 'last_Processed_date' as mark_key, max(transacted_at) as mark_value, cast(1 as bigint) as seq from fx_sales"""
    return with_fixtures(["fx_sales"], body)


def fact_employee_as_of() -> str:
    body = f"""
select d.*, h.effective_start_date, h.job_title, h.salary, h.is_current
from fx_dated_sales d left join ({SCD2_BODY}) h
  on d.emp_id = h.emp_id and d.sold_at >= h.effective_start_date and (h.effective_end_date is null or d.sold_at < h.effective_end_date)"""
    return with_fixtures(["fx_emp_before", "fx_emp_after", "fx_dated_sales"], body, _SCD2_SIDES)


def retailer_moving_sums() -> str:
    body = """
select distinct retailer_id, transacted_at, count(*) over span as n, cast(sum(cast(amount as decimal(18,2))) over span as double) as total
from fx_sales
window span as (partition by retailer_id order by transacted_at range between interval 30 days preceding and current row)"""
    return with_fixtures(["fx_sales"], body)


def retailer_sessions() -> str:
    ctes = [
        """marked as (select *, case when transacted_at <= lag(transacted_at) over w + interval 45 days then 0 else 1 end as starts
  from fx_sales where transacted_at is not null window w as (partition by retailer_id order by transacted_at, trx_id))""",
        "named as (select *, sum(starts) over (partition by retailer_id order by transacted_at, trx_id) as session from marked)",
    ]
    body = """
select retailer_id, min(transacted_at) as "start", max(transacted_at) as "last", count(*) as n,
       cast(sum(cast(amount as decimal(18,2))) as double) as total
from named group by retailer_id, session"""
    return with_fixtures(["fx_sales"], body, ctes)


def sales_cube() -> str:
    body = f"""
select year, month, country, city, cast(grouping(year, month, country, city) as bigint) as "grouping", count(*) as n,
       cast(sum(cast(amount as decimal(18,2))) as double) as total
from (select s.amount, {YEAR_MONTH}, c.country, c.city from fx_sales s left join city_dim c on s.city_id = c.city_id)
group by cube (year, month, country, city)"""
    return with_fixtures(["fx_sales", "fx_cities"], body, [CITY_DIM])


def stream_city_hourly() -> str:
    body = """
select city_id, "start", "start" + interval 1 hour as "end", count(*) filter (not late) as n,
       cast(coalesce(sum(amount) filter (not late), 0) as double) as total, count(*) filter (late) as n_late,
       cast(coalesce(sum(amount) filter (late), 0) as double) as total_late
from (select *, date_trunc('hour', sold_at) as "start", trx_id % 9 = 0 and year(sold_at) < 1996 as late from fx_timed_sales)
where "start" + interval 1 hour <= (select max(sold_at) - interval 2 days from fx_timed_sales)
group by city_id, 2"""
    return with_fixtures(["fx_timed_sales"], body)


def stream_first_sale() -> str:
    return with_fixtures(["fx_timed_sales"], "select trx_id, city_id, sold_at, cast(amount as double) as amount from fx_timed_sales")


def stream_sale_corrections() -> str:
    body = """
select trx_id, city_id, sold_at, cast(amount as double) as amount, sold_at + to_days(cast(trx_id % 11 as integer)) as changed_at,
       cast(amount + 1 as double) as new_amount
from fx_timed_sales where trx_id % 4 = 0 and trx_id % 11 <= 7"""
    return with_fixtures(["fx_timed_sales"], body)


def sales_price_band() -> str:
    body = """
select band_id, any_value(lower) as lower, any_value(upper) as upper, count(amount) as n, cast(sum(cast(amount as decimal(18,2))) as double) as total
from fx_bands left join fx_sales on (lower is null or amount >= lower) and (upper is null or amount < upper)
group by band_id"""
    return with_fixtures(["fx_bands", "fx_sales"], body)


def fact_reconciliation() -> str:
    columns = "transacted_at, trx_id, retailer_id, description, amount, city_id"
    body = f"""
select {columns}, cast(sum(a) as bigint) as in_fact, cast(sum(b) as bigint) as in_source
from (select {columns}, 1 as a, 0 as b from fx_sales union all select {columns}, 0, 1 from fx_sales_before)
group by all having sum(a) <> sum(b)"""
    return with_fixtures(["fx_sales", "fx_sales_before"], body)


def fact_sketches() -> str:
    body = """
select cast(year(transacted_at) as integer) as year, count(*) as n, count(distinct retailer_id) as retailers,
       true as n_renewed, true as distinct_within, true as median_within
from fx_sales group by 1"""
    return with_fixtures(["fx_sales"], body)


def source_variant_sales() -> str:
    body = """
select trx_id as source_id, case when not broken then trx_id end as trx_id, case when not broken then retailer_id end as retailer_id,
       case when not broken and (trx_id % 7 = 0 or trx_id % 11 <> 0) then cast(cast(amount as decimal(18,2)) as double) end as amount,
       case when not broken and trx_id % 13 <> 0 and trx_id % 5 <> 0 then city_id end as city_id,
       case when not broken then cast(transacted_at as date) end as day,
       concat_ws(',', case when not broken and trx_id % 7 <> 0 and trx_id % 11 = 0 then 'amount' end,
                      case when not broken and trx_id % 13 = 0 then 'city_id' end) as misfits,
       case when not broken and trx_id % 6 = 0 then 'agent,coupon' else '' end as unknown, broken
from (select *, trx_id % 101 = 0 as broken from fx_sales)"""
    return with_fixtures(["fx_sales"], body)


def oracle_queries() -> dict[str, str]:
    return {
        "source_csv_roundtrip": roundtrip(),
        "source_json_roundtrip": roundtrip(),
        "source_parquet_roundtrip": roundtrip(),
        "write_modes_partition_overwrite": write_modes(),
        "schema_check_report": schema_report(),
        "clean_employees": clean_employees(),
        "email_flag": email_flag(),
        "employee_rank": employee_rank(),
        "employee_chain": employee_chain(),
        "valid_employees": valid_employees(),
        "bad_employee_audit": bad_employee_audit(),
        "quality_counts": quality_counts(),
        "employee_rules_valid": employee_rules(True),
        "employee_rules_bad": employee_rules(False),
        "sales_city_enriched": sales_city("inner"),
        "sales_city_left": sales_city("left"),
        "sales_city_orphans": sales_city("left_anti"),
        "city_dim": city_dim(),
        "employee_dim_ids": employee_dim_ids(),
        "sales_fact_assigned": sales_fact_assigned(),
        "date_dim": date_dim(),
        "sales_max_date": sales_max_date(),
        "sales_year_month": sales_year_month(),
        "sales_staging": sales_staging(),
        "employee_staging": employee_staging(),
        "scd1_merge": scd1_merge(),
        "scd1_change_types": scd1_change_types(),
        "scd1_snapshot": scd1_snapshot(),
        "scd1_strict_merge": scd1_strict_merge(),
        "scd1_merge_null_keys": scd1_merge_null_keys(),
        "scd2_merge": scd2_merge(),
        "scd2_merge_null_keys": scd2_merge_null_keys(),
        "scd2_current": scd2_current(),
        "watermark_latest": watermark_latest(),
        "batch_decision": batch_decision(),
        "incremental_slice": incremental_slice(),
        "batch_first_load": batch_first_load(),
        "batch_incremental": batch_incremental(),
        "batch_crash_replay": batch_incremental(),
        "batch_late_delivery": batch_late_delivery(),
        "batch_zoned_timestamps": batch_zoned_timestamps(),
        "batch_email_key": batch_email_key(),
        "batch_from_csv": batch_from_csv(),
        "fact_employee_as_of": fact_employee_as_of(),
        "retailer_moving_sums": retailer_moving_sums(),
        "retailer_sessions": retailer_sessions(),
        "sales_cube": sales_cube(),
        "sales_price_band": sales_price_band(),
        "fact_reconciliation": fact_reconciliation(),
        "fact_sketches": fact_sketches(),
        "source_variant_sales": source_variant_sales(),
        "stream_scd1_merge": scd1_merge(),
        "stream_city_hourly": stream_city_hourly(),
        "stream_first_sale": stream_first_sale(),
        "stream_sale_corrections": stream_sale_corrections(),
        "batch_audit": batch_audit(),
        "batch_employee_dim": batch_employee_dim(),
        "batch_date_dim": batch_date_dim(),
        "batch_rerun_control": batch_rerun_control(),
    }
