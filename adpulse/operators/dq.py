"""Data-quality audits (A8, A9) as single-pass aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_audit(df: DataFrame, key: str = "id") -> DataFrame:
    """Rows before and after dropping duplicate ``key``s (null keys count as
    one group, as in ``dropDuplicates``) and the difference, in one pass."""
    after = (F.count_distinct(F.col(key))
             + F.coalesce(F.max(F.when(F.col(key).isNull(), F.lit(1)).otherwise(F.lit(0))), F.lit(0))).cast("long")
    return (df.agg(F.count(F.lit(1)).alias("rows_before"), after.alias("rows_after"))
            .withColumn("duplicates_removed", F.col("rows_before") - F.col("rows_after")))


def null_audit(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column, how many nulls and whether there is any (one scan,
    then unpivoted to one row per column)."""
    cols = list(cols or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = counts.unpivot([], cols, "column_name", "null_count")
    return long.withColumn("has_nulls", F.col("null_count") > 0)
