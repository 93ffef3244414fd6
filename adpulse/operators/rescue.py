"""Raw lines whose fields are unknown or of another shape (S1): kept beside the typed columns.

The fixed schema drops what it does not name and turns what does not fit into null or
raw text.  Here each line gives the typed columns and ``rescued``, a map of the
fields that the schema has no place for, as variants:

* unknown: a field that the schema does not name;
* mistyped: an object or array where a scalar is expected, or a ``created`` that is
  no time.  Its typed column is null.

Numbers and flags in text columns are no drift: the ingest casts text.  A line is
broken when it is no JSON object; such lines go to the caller with their text.  Blank
lines are skipped, and JSON nulls count as absent, as in ``read_raw_json``.  Of a field
that a line repeats, the last value counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from adpulse.schemas import RAW_SCHEMA

RESCUED = "rescued"


def _is_nested(value: Column) -> Column:
    return F.coalesce(F.substring(F.schema_of_variant(value), 1, 5).isin("OBJEC", "ARRAY"), F.lit(False))


def _is_null(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value) == "VOID", F.lit(True))


def rescue_lines(lines: DataFrame, schema: StructType = RAW_SCHEMA, text: str = "value") -> tuple[DataFrame, DataFrame]:
    """(typed columns and ``rescued``, broken lines as ``line``) of a column of JSON lines.

    ``rescued`` is null where nothing was rescued.  Other columns of ``lines`` are passed on;
    their names must not be those of the result.
    """
    others = [c for c in lines.columns if c != text]
    taken = {f.name.lower() for f in schema.fields} | {RESCUED, "line"}
    if clash := [c for c in others if c.lower() in taken]:
        raise ValueError(f"columns beside the lines have names of the result: {clash}")
    lines = lines.filter(F.col(text).rlike(r"\S")).withColumn("__all", F.from_json(text, "map<string,variant>"))
    broken = lines.filter(F.col("__all").isNull()).select(*others, F.col(text).alias("line"))
    # The last of repeated fields, as the typed columns have it; looked for only where one is repeated.
    names, n = F.map_keys("__all"), F.size("__all")
    last = F.filter(F.map_entries("__all"), lambda e, i: ~F.array_contains(F.slice(names, i + 2, n), e["key"]))
    fields = F.when(F.size(F.array_distinct(names)) == n, F.col("__all")).otherwise(F.map_from_entries(last))
    good = (lines.filter(F.col("__all").isNotNull())
            .withColumns({"__fields": fields, "__typed": F.from_json(text, schema)}))

    def typed(f) -> Column:
        value = F.col("__typed")[f.name]
        if isinstance(f.dataType, StringType):
            value = F.when(~_is_nested(F.try_element_at("__fields", F.lit(f.name))), value)
        return value.alias(f.name)

    texts = [f.name for f in schema.fields if isinstance(f.dataType, StringType)]

    def is_drift(name: Column, value: Column) -> Column:
        drift = F.when(name.isin(texts), _is_nested(value)).when(~name.isin([f.name for f in schema.fields]), F.lit(True))
        for f in schema.fields:
            if f.name not in texts:
                drift = drift.when(name == f.name, F.col("__typed")[f.name].isNull())
        return drift & ~_is_null(value)
    rescued = F.map_filter("__fields", is_drift)
    good = good.withColumn(RESCUED, rescued).withColumn(RESCUED, F.when(F.size(RESCUED) > 0, F.col(RESCUED)))
    return good.select(*others, *(typed(f) for f in schema.fields), RESCUED), broken


def read_rescued(spark, path: str, schema: StructType = RAW_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """``rescue_lines`` of the JSON-lines files at ``path``."""
    return rescue_lines(spark.read.text(path), schema)


def drift_report(good: DataFrame, schema: StructType = RAW_SCHEMA) -> DataFrame:
    """``field, reason, lines, type``: what was rescued, how often, and the type that all its
    values fit into.  The aggregate combines before the shuffle; a field is one row."""
    # The outer form: of a plain explode Spark derives a filter that parses every line once more per field.
    found = good.select(F.explode_outer(RESCUED).alias("field", "value")).filter("field is not null")
    reason = F.when(F.col("field").isin([f.name for f in schema.fields]), "mistyped").otherwise("unknown")
    return (found.groupBy("field").agg(F.count(F.lit(1)).alias("lines"), F.schema_of_variant_agg("value").alias("type"))
            .select("field", reason.alias("reason"), "lines", "type"))
