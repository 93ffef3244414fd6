"""Stage 3 features (C3): time parts, day part, defaults, keyword flag."""

from __future__ import annotations

from pyspark.sql import DataFrame

from adpulse.functions.scalars import created_parts, keyword_flag, time_of_day
from adpulse.operators.clean import fill_defaults
from adpulse.schemas import STAGE3_DROPPED


def add_time_parts(df: DataFrame, created: str = "created") -> DataFrame:
    df = df.withColumns(created_parts(created))
    return df.withColumn("created_time_of_day", time_of_day("created_hour"))


def add_features(df: DataFrame, pattern: str = "bonus|benefit") -> DataFrame:
    """stage 2 -> stage 3: created parts, night for a null hour, contract_time
    default, contract_type/category_tag dropped, has_bonus_or_benefit."""
    df = add_time_parts(df)
    df = fill_defaults(df).drop(*STAGE3_DROPPED)
    return df.withColumn("has_bonus_or_benefit", keyword_flag("description", pattern))
