"""Daily stages composed: stage 2 (clean and locate) and stage 4 (bid)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.operators.clean import dedup_latest, drop_missing_coordinates, fill_created_reference, forward_fill
from adpulse.operators.geo import fill_from_lookup, fill_from_nearest
from adpulse.operators.synthetic import add_bid


def clean_and_locate(ads: DataFrame, places: DataFrame, fill_order: str | None = None,
                     max_km: float | None = None) -> DataFrame:
    """C2 in the reference's order: dedup by id -> fill created -> drop rows
    without coordinates -> complete places -> created as text.

    ``fill_order=None`` keeps the reference's result (ordered by created
    itself, nothing is filled); naming a column really forward-fills along it.
    ``max_km`` switches the exact-coordinate lookup to nearest-place search.
    """
    df = dedup_latest(ads, "id", ("created",))
    df = fill_created_reference(df) if fill_order is None else forward_fill(df, "created", fill_order)
    df = drop_missing_coordinates(df)
    df = fill_from_lookup(df, places) if max_km is None else fill_from_nearest(df, places, max_km)
    return df.withColumn("created", F.col("created").cast("string"))


def finalize(df: DataFrame, **bid_args) -> DataFrame:
    """C4: stage 3 -> final (adds ``bid``)."""
    return add_bid(df, key="id", **bid_args)
