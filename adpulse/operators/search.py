"""Search list (J8) and newest-k results per search (O3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The reference's fixed search titles.
DEFAULT_TITLES = ["Data Analyst", "Software Engineer", "Marketing Manager", "UX Designer",
                  "Financial Analyst"]


def search_grid(places: DataFrame, titles: Sequence[str] = DEFAULT_TITLES,
                state_col: str = "State", city_col: str = "City") -> DataFrame:
    """Every title for every (state, city).  The title list is a small
    parameter, so each place row expands it in place - no join."""
    return (places.select(F.explode(F.array(*[F.lit(t) for t in titles])).alias("Job_Title"),
                          F.col(state_col).alias("State"), F.col(city_col).alias("City")))


def latest_k(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column], k: int = 20,
             rank_col: str = "rank") -> DataFrame:
    """O3: the first ``k`` rows of each group under ``order`` (e.g. newest
    first), with their 1-based rank.

    ``row_number() <= k`` lets Spark insert a partial WindowGroupLimit before
    the shuffle, so each map task forwards at most ``k`` rows per group and a
    hot group arrives pre-trimmed.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def merge_latest(kept: DataFrame, landed: DataFrame, group_cols: Sequence[str], id_col: str, order: Sequence[Column],
                 k: int = 20, rank_col: str = "rank") -> DataFrame:
    """O3 over days: the first ``k`` distinct ids of each group from ``kept``, an earlier result
    (its ranks are ignored), and the rows ``landed`` since.

    Of an id's versions in a group the first under ``order`` counts.  A row that is not
    among the first ``k`` of its day is never among those of more days, so the result equals
    ``k`` of all rows while only the kept ones and the day are read.  ``order`` must tell rows
    of a group apart for a repeatable result.
    """
    rows = kept.select(landed.columns).unionByName(landed)
    versions = latest_k(rows, [*group_cols, id_col], order, 1, rank_col).drop(rank_col)
    return latest_k(versions, group_cols, order, k, rank_col)
