"""Column helpers shared by the text operators.

A *word* is a maximal run of characters other than ASCII white space (space, tab, LF, VT, FF, CR).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.session import scratch_path, shared_root

#: ASCII white space, as a regular-expression class body and as characters.
WS_CLASS = r"\x20\x09-\x0D"
WS_CHARS = " \t\n\x0b\x0c\r"
WORD = rf"[^{WS_CLASS}]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A plain column reference may be inlined by the optimizer into a lambda and then be evaluated
    once per element; a lambda variable cannot.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z, every other character unchanged (``lower`` would also fold É, Ñ, İ ...).

    Pure ASCII strings take the fast ``lower``; the rest the slower exact character map.
    """
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(F.translate(col, _UPPER, _UPPER.lower()))


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder (``spark.checkpoint.dir``)."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back (compressed and columnar,
    for intermediate tables that are wide or are read several times)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
