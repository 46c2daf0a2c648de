"""Row-hash expressions used for change detection.

``record_hash`` is the compatible form: SHA-256 of the fields joined by ``||``, where
``concat_ws`` skips nulls, so ``(null, 'a')`` and ``('a', null)`` hash alike and a field that
contains the separator can collide with two fields. ``strict_hash`` is injective: every field is
written as ``<length>:<text>`` and a null as ``~``, which no length-prefixed field can equal.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: field separator of the compatible row hash.
HASH_SEPARATOR = "||"


def _as_text(name: str | Column) -> Column:
    col = F.col(name) if isinstance(name, str) else name
    return col.cast("string")


def record_hash(columns: Iterable[str | Column]) -> Column:
    """sha2(concat_ws('||', c1, c2, ...), 256); nulls are skipped as in concat_ws."""
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *[_as_text(c) for c in columns]), 256)


def strict_hash(columns: Iterable[str | Column]) -> Column:
    """Injective row hash: length-prefixed fields, explicit null marker."""
    parts = []
    for c in columns:
        text = _as_text(c)
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~")))
    return F.sha2(F.concat_ws("|", *parts), 256)
