"""Declared input schemas and the column lists the operators work on.

The three StructTypes are the declared contracts of the inputs. Nullability is declared but
not enforced by Spark readers; ``operators.quality.schema_report`` counts the violations.
"""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Declared input schemas (names, types, nullability) of the three sources.
EMPLOYEES = StructType(
    [
        StructField("first_name", StringType(), False),
        StructField("last_name", StringType(), False),
        StructField("job_title", StringType(), True),
        StructField("dob", DateType(), False),
        StructField("email", StringType(), True),
        StructField("phone", StringType(), True),
        StructField("salary", IntegerType(), True),
        StructField("department_id", IntegerType(), False),
    ]
)

SALES = StructType(
    [
        StructField("transacted_at", TimestampType(), False),
        StructField("trx_id", IntegerType(), True),
        StructField("retailer_id", IntegerType(), True),
        StructField("description", StringType(), True),
        StructField("amount", DoubleType(), True),
        StructField("city_id", IntegerType(), False),
    ]
)

CITIES = StructType(
    [
        StructField("city_id", IntegerType(), False),
        StructField("city", StringType(), False),
        StructField("state", StringType(), False),
        StructField("state_abv", StringType(), True),
        StructField("country", StringType(), False),
    ]
)

# Business key of an employee (dedup partition) and the dedup preference.
EMPLOYEE_KEY = ["department_id", "phone", "email"]

# Columns fed to the row hashes, in this order.
SALES_HASH_COLUMNS = ["retailer_id", "description", "amount", "city_id", "emp_id"]
EMPLOYEE_HASH_COLUMNS = ["first_name", "last_name", "job_title", "phone", "salary", "department_id"]

# Columns a type 1 merge overwrites on a changed sales row.
SALES_UPDATE_COLUMNS = ["retailer_id", "description", "amount", "city_id", "emp_id", "record_hash"]

# Output partitioning of the published tables.
SALES_FACT_PARTITIONS = ["year", "month"]
EMPLOYEE_DIM_PARTITIONS = ["department_id"]
CITY_DIM_PARTITIONS = ["country"]

SCD2_COLUMNS = ["effective_start_date", "effective_end_date", "is_current"]
