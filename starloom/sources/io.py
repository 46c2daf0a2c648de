"""Readers and writers for CSV, JSON, Parquet and Delta (by format name).

Readers take a declared schema, so no inference pass runs and types do not drift between runs.
Writers take a save mode, optional partition columns and dynamic partition overwrite, set on
the writer (not on the session), so a partitioned overwrite replaces only the partitions that
are present in the data.
"""

from __future__ import annotations

from enum import Enum
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class WriteMode(str, Enum):
    """Save modes of ``DataFrameWriter.mode``."""

    OVERWRITE = "overwrite"
    APPEND = "append"
    IGNORE = "ignore"
    ERROR_IF_EXISTS = "errorifexists"


FORMATS = ("csv", "json", "parquet", "delta")

#: What a value may hold survives a CSV file: a quote is doubled (RFC 4180), a backslash is a character, and a
#: field may have line breaks. An unquoted empty field is null and a quoted one the empty string; for that the
#: reader's text for null must be one that no field has, here a code point that is no character.
_CSV_READ = {"header": True, "escape": '"', "nullValue": "\uffff"}
_CSV_WRITE = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_table(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "parquet",
    schema: StructType | str | None = None,
    infer_schema: bool = False,
    corrupt_column: str | None = None,
    options: dict | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Read a table (one path or several). CSV gets a header; a declared schema skips the inference job.

    CSV fields may hold line breaks, so a file is one task; write many files of moderate size, or say
    ``multi_line=False`` for files without such fields, which Spark then splits.

    ``corrupt_column`` keeps unparsable CSV/JSON lines in a string column (PERMISSIVE mode) so
    that they can be routed to an audit instead of becoming silent nulls.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; expected one of {FORMATS}")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(**_CSV_READ, multiLine=multi_line)
    if schema is not None:
        if corrupt_column and fmt in ("csv", "json"):
            if isinstance(schema, StructType):
                from pyspark.sql.types import StringType, StructField

                schema = StructType(list(schema.fields) + [StructField(corrupt_column, StringType(), True)])
            else:
                schema = f"{schema}, {corrupt_column} string"
        reader = reader.schema(schema)
    elif fmt == "csv" and infer_schema:
        reader = reader.option("inferSchema", True)
    if corrupt_column and fmt in ("csv", "json"):
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_column)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    try:
        return reader.load(path)
    except Exception as exc:  # the Delta connector is an optional jar
        if fmt == "delta" and "DATA_SOURCE_NOT_FOUND" in str(exc):
            raise RuntimeError("format 'delta' needs the Delta Lake connector on the classpath") from exc
        raise


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: WriteMode | str = WriteMode.OVERWRITE,
    partition_by: Iterable[str] | str | None = None,
    dynamic_overwrite: bool = True,
    rebalance: bool = True,
    options: dict | None = None,
) -> None:
    """Write a table.

    * ``partition_by`` may be None, one name or several; None writes an unpartitioned table.
    * ``dynamic_overwrite``: an overwrite of a partitioned table replaces only the partitions
      present in ``df``. An unpartitioned overwrite always replaces the whole table.
    * ``rebalance``: a REBALANCE hint on the partition columns lets AQE split a hot partition
      into several tasks and merge small ones, which bounds both file size and file count.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; expected one of {FORMATS}")
    mode = WriteMode(mode).value
    if isinstance(partition_by, str):
        partition_by = [partition_by]
    partition_by = [c for c in (partition_by or []) if c is not None]
    if rebalance and partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode)
    if fmt == "csv":
        writer = writer.options(**_CSV_WRITE)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if dynamic_overwrite:
            writer = writer.option("partitionOverwriteMode", "dynamic")
    for key, value in (options or {}).items():
        writer = writer.option(key, value)
    try:
        writer.save(path)
    except Exception as exc:
        if fmt == "delta" and "DATA_SOURCE_NOT_FOUND" in str(exc):
            raise RuntimeError("format 'delta' needs the Delta Lake connector on the classpath") from exc
        raise


def path_exists(spark: SparkSession, path: str) -> bool | None:
    """Whether ``path`` exists, asked of the Hadoop file system of that path (any scheme).

    Returns None when the JVM gateway is not available (Spark Connect); callers then probe by
    reading.
    """
    sc = spark.sparkContext
    try:
        jvm, jsc = sc._jvm, sc._jsc
    except Exception:  # pragma: no cover - Spark Connect
        return None
    if jvm is None or jsc is None:
        return None
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return bool(hpath.getFileSystem(jsc.hadoopConfiguration()).exists(hpath))


def read_if_exists(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame | None:
    """The table at ``path``, or None when nothing has been written there yet."""
    from pyspark.errors import AnalysisException

    if path_exists(spark, path) is False:
        return None
    try:
        df = read_table(spark, path, fmt=fmt, schema=schema)
        if schema is None:
            df.schema  # forces the listing, raises on a missing path
        else:
            spark.read.format(fmt).load(path).schema
        return df
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return None
        raise


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the Hadoop file system of its path; absent is fine."""
    hpath, fs = _hadoop(spark, path)
    fs.delete(hpath, True)
