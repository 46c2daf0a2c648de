"""starloom: a star-schema warehouse maintained with Spark DataFrames.

Operators are ``DataFrame -> DataFrame`` transformations; Catalyst plans them.
Sub-packages:

* ``sources``    readers and writers (CSV, JSON, Parquet, Delta by name), write modes
* ``functions``  column expressions (row hashes, age rule) and the distributed row number
* ``operators``  quality rules, dimensions, facts, SCD merges, high-water-mark control
* ``plans``      the batch job, versioned tables and their publisher, fixtures, registered queries
* ``streaming``  the same type 1 merge driven by Structured Streaming
"""

__version__ = "0.1.0"

from starloom.functions.hashing import record_hash, strict_hash
from starloom.functions.ranking import distributed_row_number
from starloom.operators.control import decide, incremental_slice, latest_marks
from starloom.operators.dims import assign_keys, city_dim, date_dim
from starloom.operators.facts import add_year_month, assign_employee, batch_max, employee_staging, enrich_with_city, sales_staging
from starloom.operators.merge import merge_scd1, merge_scd1_snapshot, merge_scd2
from starloom.operators.quality import check_schema, clean_employees, employee_rules, flag_email, rank_employees, schema_report, split_employees
from starloom.plans.batch import run_batch, run_batch_from
from starloom.plans.publish import upsert_batch
from starloom.plans.store import Store
from starloom.sources.io import WriteMode, read_table, write_table

__all__ = [
    "Store", "WriteMode", "add_year_month", "assign_employee", "assign_keys", "batch_max", "check_schema", "city_dim",
    "clean_employees", "date_dim", "decide", "distributed_row_number", "employee_rules", "employee_staging",
    "enrich_with_city", "flag_email", "incremental_slice", "latest_marks", "merge_scd1", "merge_scd1_snapshot",
    "merge_scd2", "rank_employees", "read_table", "record_hash", "run_batch", "run_batch_from", "sales_staging",
    "schema_report", "split_employees", "strict_hash", "upsert_batch", "write_table",
]
