"""Audits (A8, A9) kept per day that merge to a month without reading the rows again.

One row per day holds exact counts (rows, nulls of each column) and sketches: a
HyperLogLog sketch of each column's different values and a KLL sketch of the number
columns' quantiles.  ``merge_audits`` adds counts and merges sketches, so months,
years or any set of days come from the days' rows.  Sketches have a fixed size and
combine before the shuffle; a day that holds most rows costs its task no more.

Bounds: ``DISTINCT_ERROR`` relative (about five standard errors at 2^14 registers) and
``RANK_ERROR`` of the rank of a quantile.  Nulls are counted and take no part in
sketches; rows with a null day form a day of their own.  A column of nulls only has 0
different values and no quantile.  An empty table gives no days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REGISTERS, KLL_SIZE = 14, 400
DISTINCT_ERROR, RANK_ERROR = 0.033, 0.015


def daily_audit(df: DataFrame, day: str, cols: Sequence[str], numbers: Sequence[str] = ()) -> DataFrame:
    """One row per ``day``: ``rows, null_<c>, distinct_<c>`` (sketch) and ``quantiles_<c>`` (sketch) of numbers."""
    return df.groupBy(day).agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols),
        *(F.hll_sketch_agg(F.col(c).cast("string"), F.lit(REGISTERS)).alias(f"distinct_{c}") for c in cols),
        *(F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(KLL_SIZE)).alias(f"quantiles_{c}") for c in numbers))


def merge_audits(audits: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The days' audits as one for each value of ``by`` (none: one for all)."""
    def merged(c: str):
        if c.startswith("distinct_"):
            return F.hll_union_agg(c)
        return F.kll_merge_agg_double(c) if c.startswith("quantiles_") else F.sum(c)
    kept = [c for c in audits.columns if c == "rows" or c.startswith(("null_", "distinct_", "quantiles_"))]
    return audits.groupBy(*by).agg(*(merged(c).alias(c) for c in kept))


def audit_report(audits: DataFrame, quantiles: Sequence[float] = (0.5,)) -> DataFrame:
    """Sketches replaced by what they say: ``distinct_<c>`` as a number, ``quantiles_<c>`` as an array."""
    out = audits
    for c in audits.columns:
        if c.startswith("distinct_"):
            out = out.withColumn(c, F.coalesce(F.hll_sketch_estimate(c), F.lit(0).cast("long")))
        elif c.startswith("quantiles_"):
            each = F.array(*(F.kll_sketch_get_quantile_double(c, F.lit(float(q))) for q in quantiles))
            out = out.withColumn(c, F.when(F.kll_sketch_get_n_double(c) > 0, each))
    return out
