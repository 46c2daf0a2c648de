"""A business key holding a third of all rows: results equal a plain window, no group in one task."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom import schemas
from starloom.operators import quality
from tests.conftest import rows

N = 60000


def skewed_employees(spark):
    i = F.col("id")
    hot = (i % 3) == 0  # a third of the rows share department 1, phone 'HOT', e-mail 'h@o.t'
    return spark.range(N).select(
        i.alias("src_id"),
        F.lit("A").alias("first_name"),
        F.lit("B").alias("last_name"),
        F.lit("t").alias("job_title"),
        F.lit(dt.date(1990, 1, 1)).alias("dob"),
        F.when(hot, "h@o.t").when(i % 7 == 0, "bad").otherwise(F.concat(F.lit("u"), (i % 500).cast("string"), F.lit("@x.y"))).alias("email"),
        F.when(hot, "HOT").otherwise((i % 97).cast("string")).alias("phone"),
        F.when(i % 11 == 0, None).otherwise((i * 7919) % 1000).cast("int").alias("salary"),
        F.when(hot, 1).otherwise((i % 5).cast("int")).alias("department_id"),
    )


def brute_force(df):
    w = Window.partitionBy(*schemas.EMPLOYEE_KEY).orderBy(F.col("salary").desc_nulls_last(), "src_id")
    ranked = df.withColumn("rn", F.row_number().over(w))
    ok = F.coalesce(quality.email_is_valid("email"), F.lit(False))
    return ranked.filter((F.col("rn") == 1) & ok), ranked.filter((F.col("rn") > 1) | ~ok)


def test_split_on_hot_key_equals_brute_force(spark):
    df = skewed_employees(spark)
    split = quality.split_employees(df, tie_breakers=["src_id"])
    valid, bad = brute_force(df)
    assert rows(split.valid, "src_id") == rows(valid, "src_id")
    assert rows(split.audit, "src_id") == rows(bad, "src_id")


def test_rank_on_hot_key_equals_brute_force_and_spreads(spark):
    df = skewed_employees(spark)
    ranked = quality.rank_employees(df, tie_breakers=["src_id"])
    w = Window.partitionBy(*schemas.EMPLOYEE_KEY).orderBy(F.col("salary").desc_nulls_last(), "src_id")
    assert rows(ranked, "src_id", "row_num") == rows(df.withColumn("row_num", F.row_number().over(w)), "src_id", "row_num")
    from starloom.functions.ranking import range_numbered

    ranged = range_numbered(df, schemas.EMPLOYEE_KEY, [F.col("salary").desc_nulls_last(), "src_id"])
    hot = ranged.filter("phone = 'HOT'").groupBy("__pid").count().collect()
    assert len(hot) > 1 and max(r["count"] for r in hot) < N // 3


def test_identical_hot_copies(spark):
    same = spark.range(30000).select(
        F.lit(1).alias("src_id"), F.lit("A").alias("first_name"), F.lit("B").alias("last_name"), F.lit("t").alias("job_title"),
        F.lit(dt.date(1990, 1, 1)).alias("dob"), F.lit("a@b.c").alias("email"), F.lit("1").alias("phone"),
        F.lit(5).alias("salary"), F.lit(1).alias("department_id"),
    )
    split = quality.split_employees(same)
    assert split.valid.count() == 1
    assert split.audit.count() == 29999
    from starloom.functions.ranking import range_numbered

    ranged = range_numbered(same, schemas.EMPLOYEE_KEY, [F.col("salary").desc_nulls_last()], num_partitions=6)
    per_task = [r["count"] for r in ranged.groupBy("__pid").count().collect()]
    assert len(per_task) > 3 and max(per_task) < 15000  # identical rows are spread
    counts = split.counts().first()
    assert (counts.input_rows, counts.duplicates) == (30000, 29999)
