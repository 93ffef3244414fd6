"""Mart queries (C8 and its parts) over F1 (parts as jobs/campaigns) + F3 (lineitem as clicks)."""

from __future__ import annotations

from pyspark.sql import functions as F

from adpulse import fixtures as fx
from adpulse.operators import mart_delta as delta
from adpulse.operators import performance as perf
from adpulse.plans.catalog import register
from adpulse.sources import readers, sinks

# The mart stated from its formulas: totals of a job's day, shares of a firm's
# day, and the running spend of a job, before any campaign is looked at.
def _placed(wide: bool = False, hot: bool = False) -> str:
    jobs = fx.jobs_from_parts_sql(wide)
    if hot:
        jobs = (f"SELECT * REPLACE (CASE WHEN job_id % 3 = 0 THEN (SELECT min(company_name) FROM ({jobs})) "
                f"ELSE company_name END AS company_name) FROM ({jobs})")
    return f"""
paid AS (SELECT job_id, date, sum(cost) AS money, count(*) AS n, sum(is_applicant) AS hired
         FROM ({fx.lineitem_as_clicks_sql()}) GROUP BY job_id, date),
placed AS (
    SELECT p.job_id, p.date, j.title, j.city, j.company_name AS firm, p.money, p.n, p.hired,
           sum(p.money) OVER (PARTITION BY p.job_id ORDER BY p.date
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS money_before,
           sum(p.money) OVER firm_day AS firm_money, count(*) OVER firm_day AS firm_jobs
    FROM ({jobs}) j JOIN paid p USING (job_id)
    WINDOW firm_day AS (PARTITION BY j.company_name, p.date)),
owned AS (SELECT k.*, placed.* EXCLUDE (firm)
          FROM placed JOIN ({fx.campaigns_from_parts_sql(wide)}) k ON k.company_name = placed.firm)"""


_PLACED = _placed()


def _mart_sql(wide: bool = False, hot: bool = False) -> str:
    return f"""
WITH {_placed(wide, hot)},
shares AS (
    SELECT *, CAST(money AS DOUBLE) AS spend, CAST(firm_money AS DOUBLE) AS total_spend,
           CAST(money_before AS DOUBLE) AS spend_until_yesterday, CAST(budget AS DOUBLE) / firm_jobs AS budget_per_job,
           1 + CAST(date_diff('day', date, last_day(date)) AS INTEGER) AS remaining_days_in_month
    FROM owned),
days AS (
    SELECT *, (budget_per_job - coalesce(spend_until_yesterday, 0.0::DOUBLE)) / remaining_days_in_month AS job_daily_budget,
           CASE WHEN hired > 0 THEN spend / CAST(hired AS DOUBLE) END AS cost_per_applicant
    FROM shares)
SELECT date, campaign_id, job_id, company_name, state, title, city, margin AS campaign_margin, budget AS campaign_budget,
       cpa_target, n AS clicks, CAST(hired AS BIGINT) AS applicants, spend, total_spend, spend_until_yesterday,
       spend / n AS cpc, CAST(hired AS DOUBLE) / n AS conversion_rate, cost_per_applicant,
       CASE WHEN cpa_target <> 0 THEN cost_per_applicant / cpa_target END AS cpa_target_rate,
       remaining_days_in_month, budget_per_job, job_daily_budget,
       CASE WHEN job_daily_budget > 0 THEN spend / job_daily_budget END AS daily_budget_util_rate,
       CASE WHEN budget <> 0 THEN total_spend / budget END AS campaign_budget_util_rate
FROM days
"""


MART_SQL = _mart_sql()


def _inputs(spark, sf_dir, wide: bool = False):
    return (fx.campaigns_from_parts(spark, sf_dir, wide), fx.jobs_from_parts(spark, sf_dir, wide),
            fx.lineitem_as_clicks(spark, sf_dir))


@register("performance_mart", MART_SQL)
def performance_mart(spark, sf_dir):
    return perf.performance_mart(*_inputs(spark, sf_dir))


@register("performance_mart_wide", _mart_sql(wide=True))
def performance_mart_wide(spark, sf_dir):
    """C8 over campaigns and firms whose number grows with the data."""
    return perf.performance_mart(*_inputs(spark, sf_dir, wide=True))


@register("performance_mart_hot", _mart_sql(hot=True))
def performance_mart_hot(spark, sf_dir):
    """C8 with a third of all jobs at one company, whose fan-out is salted."""
    campaigns, jobs, clicks = _inputs(spark, sf_dir)
    hot = F.when(F.col("job_id") % 3 == 0, jobs.agg(F.min("company_name")).scalar()).otherwise(F.col("company_name"))
    return perf.performance_mart(campaigns, jobs.withColumn("company_name", hot), clicks, materialize=True)


@register("performance_mart_incremental", MART_SQL)
def performance_mart_incremental(spark, sf_dir):
    """C8 and S8 kept up to date: a first load with clicks missing, wrong and to be
    removed, then a batch of changes; the result is that of a rebuild over the final clicks."""
    campaigns, jobs, clicks = _inputs(spark, sf_dir)
    base = sinks.scratch_path(spark, "incremental-mart")
    part = F.pmod("job_id", F.lit(50))
    wrong = clicks.filter(part == 1).withColumn("cost", (F.col("cost") + 1).cast(dict(clicks.dtypes)["cost"]))
    strays = clicks.filter(part == 2).withColumn("date", F.date_add("date", 3))
    delta.refresh_mart(campaigns, jobs, base, 0, clicks.filter(part > 1).unionByName(wrong).unionByName(strays))
    delta.refresh_mart(campaigns, jobs, base, 1, clicks.filter(part <= 1), wrong.unionByName(strays))
    return delta.read_mart(spark, base, perf.MART_COLUMNS)


@register("clicks_agg", f"""
WITH {_PLACED}
SELECT date, campaign_id, job_id, company_name, state, title, city, cpa_target, n AS clicks,
       CAST(hired AS BIGINT) AS applicants, CAST(money AS DOUBLE) AS spend
FROM owned""")
def clicks_agg(spark, sf_dir):
    rows = perf.clicks_agg(*_inputs(spark, sf_dir))
    return rows.select("campaign_id", "company_name", "state", "cpa_target", "job_id", "title",
                       "city", "date", F.col("spend_sum").cast("double").alias("spend"),
                       "clicks", "applicants")


@register("campaign_stats", f"""
WITH {_PLACED}
SELECT DISTINCT date, campaign_id, company_name, state, cpa_target, budget AS campaign_budget,
       margin AS campaign_margin, firm_jobs AS job_count, CAST(firm_money AS DOUBLE) AS total_spend
FROM owned""")
def campaign_stats(spark, sf_dir):
    return perf.campaign_stats_table(*_inputs(spark, sf_dir))


@register("spend_until_yesterday", f"""
WITH {_PLACED}
SELECT date, campaign_id, job_id, CAST(money_before AS DOUBLE) AS spend_until_yesterday FROM owned""")
def spend_until_yesterday(spark, sf_dir):
    rows = perf.clicks_agg(*_inputs(spark, sf_dir))
    return rows.select("campaign_id", "job_id", "date",
                       F.col("spend_until_yesterday_sum").cast("double").alias("spend_until_yesterday"))


@register("performance_mart_write", MART_SQL)
def performance_mart_write(spark, sf_dir):
    """The mart written twice as one month of a date-partitioned table.

    The first write also holds a day and a job that the second does not have;
    replacing the whole month leaves neither behind, nor two copies of a row
    (the reference's INSERT would append them).
    """
    mart = perf.performance_mart(*_inputs(spark, sf_dir), materialize=True, by=["date"])
    path, month = sinks.scratch_path(spark, "performance"), {"year": 1995, "month": 1}
    latest = mart.agg(F.max("date")).scalar()
    old = (mart.filter(F.col("date") == latest).withColumn("date", F.date_add("date", 1))
           .withColumn("job_id", -F.col("job_id")))
    sinks.replace_scope(old, path, month, ["date"])
    sinks.replace_scope(mart, path, month, ["date"], clustered=True)
    return readers.read_month(spark, path, 1995, 1, mart.schema).select(*perf.MART_COLUMNS)


@register("performance_mart_sql", MART_SQL)
def performance_mart_sql(spark, sf_dir):
    """C8 through the SQL API: fixtures registered as views, mart as a view."""
    from adpulse.plans.sql_views import create_performance_view

    campaigns, jobs, clicks = _inputs(spark, sf_dir)
    names = {"campaigns": "adpulse_campaigns", "jobs": "adpulse_jobs", "clicks": "adpulse_clicks"}
    for df, key in ((campaigns, "campaigns"), (jobs, "jobs"), (clicks, "clicks")):
        df.createOrReplaceTempView(names[key])
    return create_performance_view(spark, "adpulse_performance", **names).select(*perf.MART_COLUMNS)
