"""Monthly jobs (C5): one row per job id per month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from adpulse.operators.clean import dedup_latest


def monthly_jobs(final_ads: DataFrame, order: Sequence[str] = ("created",)) -> DataFrame:
    """All final ads of a month -> jobs: newest version of each id, id -> job_id."""
    return dedup_latest(final_ads, "id", order).withColumnRenamed("id", "job_id")
