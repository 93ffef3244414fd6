"""Incremental performance mart (C8, S8): late clicks change only what depends on them.

The clicks of a month are kept as daily sums per (job, date) in a log of
batches: ``daily/batch=N`` holds what batch N added (removed clicks count
negatively), so the present sums are the sums over all batches and a batch that
is written again replaces its own rows.

A changed (job, date) reaches three kinds of mart rows: those of the job on that
date; those of its later days, whose running spend includes it; and those of all
jobs of the company on that date, whose totals include it.  The dates on which
any of these lie are rewritten as whole partitions, from the daily sums (one row
per job and day, not per click); all other partitions stay as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.operators.performance import clicks_daily, mart_rows, placed_days
from adpulse.sources import readers, sinks

_SUMS = ("spend_sum", "clicks", "applicants")


def _summed(daily: DataFrame) -> DataFrame:
    """One row per (job, date), in the types of ``daily`` (a sum of decimals is wider)."""
    kinds = dict(daily.dtypes)
    return daily.groupBy("job_id", "date").agg(*(F.sum(c).cast(kinds[c]).alias(c) for c in _SUMS))


def daily_changes(added: DataFrame, removed: DataFrame | None = None) -> DataFrame:
    """Signed sums per (job, date).  A corrected click is removed as it was and added as it is."""
    out = clicks_daily(added)
    if removed is not None:
        gone = clicks_daily(removed)
        out = _summed(out.unionByName(gone.withColumns({c: -F.col(c) for c in _SUMS})))
    return out.filter("clicks <> 0 or spend_sum <> 0 or applicants <> 0")


def present(log: DataFrame) -> DataFrame:
    """The daily sums as of now, without days whose clicks were all removed."""
    return _summed(log).filter("clicks > 0")


def affected_dates(daily: DataFrame, changes: DataFrame) -> DataFrame:
    """``date`` of every mart row that ``changes`` reach, also of days that are gone now."""
    first = changes.groupBy("job_id").agg(F.min("date").alias("__from"))
    later = daily.join(first, "job_id").filter(F.col("date") >= F.col("__from")).select("date")
    return later.unionByName(changes.select("date")).distinct()


def _log(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(f"{base}/daily").drop("batch")


def _batches(spark: SparkSession, base: str) -> list[str]:
    return [name for name in sinks.names_in(spark, f"{base}/daily") if name.startswith("batch=")]


def refresh_mart(campaigns: DataFrame, jobs: DataFrame, base: str, batch: int, added: DataFrame,
                 removed: DataFrame | None = None, match_state: bool = False) -> Sequence:
    """Take batch ``batch`` into the mart at ``base`` and return the dates that were rewritten.

    The first batch builds everything.  The batch's own folder is written first; a
    run that stops after that is simply done again with the same batch, which
    gives the same log and rewrites the same dates.
    """
    spark = jobs.sparkSession
    with sinks.scratch(spark):
        changes = daily_changes(added, removed)
        sinks.replace_scope(changes, f"{base}/daily", {"batch": batch})
        # Read back from the log, where they are stored anyway.
        changes = spark.read.schema(changes.schema).parquet(sinks.scope_path(f"{base}/daily", {"batch": batch}))
        if _batches(spark, base) == [f"batch={batch}"]:
            # Nothing was there before: the changes are the daily sums, and all their dates are new.
            daily, dates = changes.filter("clicks > 0"), changes.select("date").distinct()
        else:
            daily = sinks.materialize(present(_log(spark, base)), "daily")
            dates = affected_dates(daily, changes)
        dates = sinks.materialize(dates, "dates")
        days = sinks.materialize(placed_days(daily, jobs, match_state).join(dates, "date", "left_semi"), "job-daily")
        rows = mart_rows(days, campaigns, match_state, balanced=True, by=["date"])
        sinks.write_partitions(rows, f"{base}/performance", ["date"], clustered=True)
        # Dates that lost their last row, at most one for each day of the scope.
        wanted = [r["date"] for r in dates.collect()]
        kept = {r["date"] for r in days.select("date").distinct().collect()}
        for gone in set(wanted) - kept:
            sinks.delete(spark, f"{base}/performance/date={gone}")
    return sorted(wanted)


def read_mart(spark: SparkSession, base: str, columns: Sequence[str]) -> DataFrame:
    readers.recover_below(spark, f"{base}/performance")
    return spark.read.parquet(f"{base}/performance").select(*columns)
