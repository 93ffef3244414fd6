"""Daily campaign performance mart (C8) and its building blocks.

The reference joins campaigns x jobs x clicks first and aggregates afterwards,
so every click row is copied once per campaign of its company before the
GROUP BY, and it re-reads that join for the day totals and a self join for
the running spend.  Here everything is computed on job-day rows (clicks
aggregated per (job_id, date) with map-side partial aggregation): the running
spend is a window per job, the day totals an aggregate per (company, date)
joined back (AQE splits a hot company-day), and the campaign fan-out is the
last join, producing the output rows directly.

Money convention: spend is summed in the type of ``cost`` (DECIMAL in the
fixtures, so the sums are exact), each sum is cast to double once, and all
ratios are computed in double without rounding.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adpulse.functions.scalars import remaining_days
from adpulse.operators.skew import PER_TASK, balanced_join, heavy_keys

MART_COLUMNS = [
    "campaign_id", "company_name", "state", "cpa_target", "campaign_budget",
    "campaign_margin", "job_id", "title", "city", "date", "budget_per_job",
    "spend", "total_spend", "spend_until_yesterday", "remaining_days_in_month",
    "job_daily_budget", "campaign_budget_util_rate", "clicks", "cpc",
    "applicants", "conversion_rate", "cost_per_applicant", "cpa_target_rate",
    "daily_budget_util_rate",
]

#: Campaigns that every task may hold, when the mart is to lie together for a write.
FEW_CAMPAIGNS = 100_000


def clicks_daily(clicks: DataFrame) -> DataFrame:
    """Clicks -> one row per (job_id, date): spend (exact sum), clicks, applicants."""
    return (clicks.groupBy("job_id", "date")
            .agg(F.sum("cost").alias("spend_sum"),
                 F.count(F.lit(1)).alias("clicks"),
                 F.sum("is_applicant").cast("long").alias("applicants")))


def _keys(match_state: bool) -> list[str]:
    return ["company_name", "state"] if match_state else ["company_name"]


def _campaign_cols(campaigns: DataFrame) -> DataFrame:
    return campaigns.select("campaign_id", "company_name", "state", "cpa_target",
                            F.col("budget").alias("campaign_budget"),
                            F.col("margin").alias("campaign_margin"))


def job_daily(jobs: DataFrame, clicks: DataFrame, match_state: bool = False) -> DataFrame:
    """One row per (job, date with clicks): the job's columns, the day's
    totals and the running spend of the job's earlier rows.

    "Spend until yesterday" of (campaign, job) only depends on the job - every
    campaign of the company sees the same days - so the window runs here,
    before any fan-out, partitioned by job (at most one row per day).
    """
    return placed_days(clicks_daily(clicks), jobs, match_state)


def placed_days(daily: DataFrame, jobs: DataFrame, match_state: bool = False) -> DataFrame:
    """``job_daily`` from the daily sums of ``clicks_daily``."""
    job_cols = ["job_id", "title", "city", "company_name"] + (["state"] if match_state else [])
    w = (Window.partitionBy("job_id").orderBy("date")
         .rowsBetween(Window.unboundedPreceding, -1))
    return (daily.join(jobs.select(*job_cols), "job_id")
            .withColumn("spend_until_yesterday_sum", F.sum("spend_sum").over(w)))


def day_totals(jd: DataFrame, match_state: bool = False) -> DataFrame:
    """Per (join keys, date): jobs with clicks that day and their spend.

    Every campaign matching the keys sees exactly these jobs, so this equals
    the reference's per-(campaign, date) COUNT(DISTINCT job_id) and SUM(spend)
    without the fan-out.  Partial-then-final aggregate: safe under a hot key.
    """
    return (jd.groupBy(*_keys(match_state), "date")
            .agg(F.count(F.lit(1)).alias("job_count"),
                 F.sum("spend_sum").alias("total_spend_sum")))


def _materialize(df: DataFrame, materialize: bool, name: str = "job-daily") -> DataFrame:
    if not materialize:
        return df
    from adpulse.sources.sinks import materialize as write_and_read

    return write_and_read(df, name)


def clicks_agg(campaigns: DataFrame, jobs: DataFrame, clicks: DataFrame,
               match_state: bool = False) -> DataFrame:
    """Rows of the reference's clicks_agg CTE, one per (campaign, job, date):
    each job is credited to every campaign of its company (company-only
    join), unless ``match_state`` also requires the campaign's state."""
    jd = job_daily(jobs, clicks, match_state)
    return jd.join(_campaign_cols(campaigns), _keys(match_state))


def campaign_stats_table(campaigns: DataFrame, jobs: DataFrame, clicks: DataFrame,
                         match_state: bool = False) -> DataFrame:
    """The campaign_stats CTE: campaign columns + per-day job count and spend."""
    totals = day_totals(job_daily(jobs, clicks, match_state), match_state)
    return (_campaign_cols(campaigns).join(totals, _keys(match_state))
            .select("campaign_id", "company_name", "state", "cpa_target",
                    "campaign_budget", "campaign_margin", "date", "job_count",
                    F.col("total_spend_sum").cast("double").alias("total_spend")))


def performance_mart(campaigns: DataFrame, jobs: DataFrame, clicks: DataFrame,
                     match_state: bool = False, materialize: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """24-column daily performance per (campaign, job, date).

    All aggregation happens on job-day rows; the campaign fan-out is the last
    join.  With ``materialize`` (the monthly run asks for it) the job-day table
    is written once to the shared folder and read back, so the clicks are
    scanned and aggregated once although the table feeds the day totals, the
    rows and the count of heavy companies, whose fan-out is then salted;
    otherwise the plan stays lazy and leaves skew to the run-time skew join.
    ``by``: see ``mart_rows``.
    """
    jd = _materialize(job_daily(jobs, clicks, match_state), materialize)
    return mart_rows(jd, campaigns, match_state, balanced=materialize, by=by)


def mart_rows(jd: DataFrame, campaigns: DataFrame, match_state: bool = False, balanced: bool = False,
              per_task: int = PER_TASK, by: Sequence[str] = ()) -> DataFrame:
    """The mart from ``job_daily`` rows.  ``balanced`` (``jd`` should be stored, as it is
    counted first) salts the keys whose fan-out is too much for one task.

    What does not depend on the campaign is computed once per job and day, before the fan-out.
    With ``by`` (columns of ``jd``) the rows lie together by these columns, as a write
    in folders wants: up to ``FEW_CAMPAIGNS`` campaigns are broadcast and the job-days are
    shuffled and sorted, not the rows; with more, the rows are.
    """
    keys = _keys(match_state)
    # Stored, so that its size is known: few totals are joined without a shuffle of the days.
    rows = _per_day(jd.join(_materialize(day_totals(jd, match_state), balanced, "day-totals"), keys + ["date"]))
    few = bool(by) and campaigns.limit(FEW_CAMPAIGNS + 1).count() <= FEW_CAMPAIGNS
    if few:
        rows = _in_order(rows.hint("rebalance", *by), by).join(F.broadcast(_campaign_cols(campaigns)), keys)
    elif balanced:
        # The totals add columns, not rows, so the stored days count for them.
        heavy = F.broadcast(heavy_keys(jd, campaigns, keys, per_task))
        rows = balanced_join(rows, _campaign_cols(campaigns), keys, ["job_id", "date"], heavy=heavy)
    else:
        rows = rows.join(_campaign_cols(campaigns), keys)
    out = _per_campaign(rows).select(*MART_COLUMNS)
    return out.hint("rebalance", *by) if by and not few else out


def _in_order(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """``rows`` sorted inside their partitions for a write in folders, before a broadcast
    join copies them, which keeps the order: the copies need not be sorted.

    The filter keeps every row.  Without it the optimizer would drop a sort below a
    join and the write would sort the copies.
    """
    return rows.sortWithinPartitions(*by).filter(F.monotonically_increasing_id() >= 0)


def _per_day(rows: DataFrame) -> DataFrame:
    """The columns of the mart that all campaigns of a job's day share."""
    return (rows
            .withColumns({
                "spend": F.col("spend_sum").cast("double"),
                "total_spend": F.col("total_spend_sum").cast("double"),
                "spend_until_yesterday": F.col("spend_until_yesterday_sum").cast("double"),
                "remaining_days_in_month": remaining_days("date"),
            })
            .withColumns({
                "cpc": F.when(F.col("clicks") > 0, F.col("spend") / F.col("clicks").cast("double")),
                "conversion_rate": F.when(F.col("clicks") > 0,
                                          F.col("applicants").cast("double") / F.col("clicks").cast("double")),
                "cost_per_applicant": F.when(F.col("applicants") > 0,
                                             F.col("spend") / F.col("applicants").cast("double")),
            })
            .drop("spend_sum", "total_spend_sum", "spend_until_yesterday_sum"))


def _per_campaign(rows: DataFrame) -> DataFrame:
    """The columns of the mart that depend on the campaign."""
    budget_per_job = (F.col("campaign_budget").cast("double")
                      / F.nullif(F.col("job_count"), F.lit(0)).cast("double"))
    days = F.col("remaining_days_in_month")
    job_daily_budget = F.when(
        days > 0,
        (F.col("budget_per_job") - F.coalesce(F.col("spend_until_yesterday"), F.lit(0.0)))
        / days.cast("double"))
    return (rows
            .withColumn("budget_per_job", budget_per_job)
            .withColumn("job_daily_budget", job_daily_budget)
            .withColumns({
                "campaign_budget_util_rate":
                    F.col("total_spend") / F.nullif(F.col("campaign_budget"), F.lit(0)).cast("double"),
                "cpa_target_rate": F.col("cost_per_applicant") / F.nullif(F.col("cpa_target"), F.lit(0)).cast("double"),
                "daily_budget_util_rate": F.when(F.col("job_daily_budget") > 0,
                                                 F.col("spend") / F.col("job_daily_budget")),
            }))
