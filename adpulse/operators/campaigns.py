"""Monthly campaigns maintained incrementally.

Old campaigns never change; only (company_name, state) keys that are not yet
campaigns get new contiguous ids after the current maximum, a cpa target,
budget and margin.  Everything stays lazy: the maximum id is a scalar
subquery and an empty set of new keys simply unions nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.operators.numbering import assign_ids
from adpulse.operators.synthetic import (BUDGET_CHOICES, MARGIN_CHOICES, add_budget_margin,
                                        add_cpa_target)
from adpulse.schemas import CAMPAIGN_SCHEMA

KEYS = ["company_name", "state"]
DEFAULT_MAX_ID = 1000


def avg_bid_by_campaign(ads: DataFrame) -> DataFrame:
    """A1: average bid per (company_name, state); a null key is a group too."""
    return ads.groupBy(*KEYS).agg(F.avg("bid").alias("avg_bid"))


def max_id_or_default(old: DataFrame, default: int = DEFAULT_MAX_ID) -> DataFrame:
    """A2: one row, the greatest campaign_id, or ``default`` when there is
    none or it is 0 (the reference's ``max or 1000``)."""
    return old.agg(F.coalesce(F.nullif(F.max("campaign_id").cast("long"), F.lit(0).cast("long")),
                              F.lit(default).cast("long")).alias("max_id"))


def new_keys(agg: DataFrame, old: DataFrame, null_safe: bool = True) -> DataFrame:
    """Keys of ``agg`` that are not campaigns yet (left anti join).

    ``null_safe`` matches null parts to null parts; the reference's plain
    equality treats a key with a null part as new on every run.
    """
    old_keys = old.select(*KEYS).distinct()
    if null_safe:
        cond = [agg[k].eqNullSafe(old_keys[k]) for k in KEYS]
        return agg.join(old_keys, cond, "left_anti")
    return agg.join(old_keys, KEYS, "left_anti")


def keep_lowest_id(campaigns: DataFrame) -> DataFrame:
    """One row per (company_name, state) - the lowest campaign_id with its
    columns; null parts group together.  A ``min(struct)`` aggregate, so a
    hot key is combined map-side."""
    rest = [c for c in campaigns.columns if c not in KEYS]
    best = campaigns.groupBy(*KEYS).agg(F.min(F.struct(*rest)).alias("__b"))
    return best.select(*[F.col("__b")[c].alias(c) if c in rest else F.col(c)
                         for c in campaigns.columns])


def _typed(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CAMPAIGN_SCHEMA.fields])


def campaigns_incremental(old: DataFrame | None, ads: DataFrame, first_id: int = DEFAULT_MAX_ID + 1,
                          budgets=BUDGET_CHOICES, margins=MARGIN_CHOICES, compat: bool = False,
                          mode: str = "keyed") -> DataFrame:
    """Old campaigns (or None) + the month's final ads -> all campaigns.

    New ids continue after the current maximum (``first_id`` when there is
    none); budget and margin are uniform picks from ``budgets``/``margins``.

    ``compat=False``: rows without a company are dropped before numbering and
    the anti join is null-safe, so ids have no holes.  ``compat=True`` keeps
    the reference's order (number first, filter after) and plain equality.
    """
    spark = ads.sparkSession
    if old is None:
        old = spark.createDataFrame([], CAMPAIGN_SCHEMA)
    old = _typed(old)
    agg = avg_bid_by_campaign(ads)
    if not compat:
        agg = agg.filter(F.col("company_name").isNotNull())
    fresh = new_keys(agg, old, null_safe=not compat)
    base: Column = max_id_or_default(old, first_id - 1).scalar()
    fresh = assign_ids(fresh, KEYS, base)
    fresh = add_cpa_target(fresh, mode=mode)
    fresh = add_budget_margin(fresh, mode=mode, budgets=budgets, margins=margins)
    merged = keep_lowest_id(old.unionByName(_typed(fresh)))
    return merged.filter(F.col("company_name").isNotNull())
