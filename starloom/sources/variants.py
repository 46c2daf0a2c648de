"""Documents whose fields drift, read as VARIANT.

A document is parsed once, without a schema; each declared field is then cast on its own. What does not fit
its type is null and named in ``misfits``, fields that are not declared are named in ``unknown``, and a text that
is no JSON object is kept as ``broken``. So one odd field costs neither the row nor the file, and all of
it can go to an audit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fields of a sale and their types; text that reads as the type is taken.
SALE_FIELDS = {"trx_id": "int", "retailer_id": "int", "amount": "decimal(18,2)", "city_id": "int", "day": "date"}


def typed_fields(docs: DataFrame, doc: str, fields: dict[str, str]) -> DataFrame:
    """``docs`` without ``doc``, plus ``fields``, ``misfits`` and ``unknown`` (names in order, joined by commas; empty
    if none) and ``broken``. A null document is broken. Missing and null fields are null and fit. Fields that
    the document repeats make it broken. Columns of ``docs`` that have a field's name are replaced."""
    parsed = docs.withColumn("__v", F.try_parse_json(F.col(doc)))
    is_object = F.coalesce(F.startswith(F.schema_of_variant("__v"), F.lit("OBJECT")), F.lit(False))
    parsed = parsed.withColumn("__v", F.when(is_object, F.col("__v")))
    names = F.coalesce(F.map_keys(F.try_variant_get("__v", "$", "map<string,variant>")), F.array().cast("array<string>"))
    typed = {f: F.try_variant_get("__v", f"$.{f}", kind) for f, kind in fields.items()}
    sent = {f: F.try_variant_get("__v", f"$.{f}", "variant") for f in fields}
    misfit: list[Column] = [F.when(sent[f].isNotNull() & ~F.is_variant_null(sent[f]) & typed[f].isNull(), F.lit(f)) for f in sorted(fields)]
    unknown = F.array_sort(F.array_except(names, F.array(*map(F.lit, fields))))
    made = parsed.withColumns({
        **typed, "misfits": F.concat_ws(",", *misfit), "unknown": F.array_join(unknown, ","), "broken": F.col("__v").isNull(),
    })
    return made.drop("__v", doc)


def typed_sales(docs: DataFrame, doc: str) -> DataFrame:
    return typed_fields(docs, doc, SALE_FIELDS)
