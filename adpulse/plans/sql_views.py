"""The performance mart as Spark SQL over registered views (the reference's
SQL path), written in the aggregate-first form: clicks are grouped per
(job, date) before the campaign join, the running spend is a window per job,
and the day totals are grouped per (company, date).

    register_views(spark, base, 2025, 8)          # jobs, campaigns, clicks, ...
    spark.sql(performance_sql())                  # or create_performance_view(spark)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def performance_sql(campaigns: str = "campaigns", jobs: str = "jobs", clicks: str = "clicks") -> str:
    rd = "datediff(add_months(trunc(jd.date, 'MM'), 1), jd.date)"
    bpj = "(CAST(c.budget AS DOUBLE) / CAST(NULLIF(t.job_count, 0) AS DOUBLE))"
    suy = "CAST(jd.suy_sum AS DOUBLE)"
    jdb = f"(CASE WHEN {rd} > 0 THEN ({bpj} - COALESCE({suy}, 0.0D)) / CAST({rd} AS DOUBLE) END)"
    spend = "CAST(jd.spend_sum AS DOUBLE)"
    return f"""
WITH daily AS (
    SELECT job_id, date, SUM(cost) AS spend_sum, COUNT(1) AS clicks,
           CAST(SUM(is_applicant) AS BIGINT) AS applicants
    FROM {clicks} GROUP BY job_id, date
),
job_daily AS (
    SELECT d.job_id, d.date, d.spend_sum, d.clicks, d.applicants, j.title, j.city, j.company_name,
           SUM(d.spend_sum) OVER (PARTITION BY d.job_id ORDER BY d.date
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS suy_sum
    FROM daily d JOIN {jobs} j ON d.job_id = j.job_id
),
totals AS (
    SELECT company_name, date, COUNT(1) AS job_count, SUM(spend_sum) AS total_spend_sum
    FROM job_daily GROUP BY company_name, date
)
SELECT c.campaign_id, c.company_name, c.state, c.cpa_target, c.budget AS campaign_budget,
       c.margin AS campaign_margin, jd.job_id, jd.title, jd.city, jd.date,
       {bpj} AS budget_per_job,
       {spend} AS spend,
       CAST(t.total_spend_sum AS DOUBLE) AS total_spend,
       {suy} AS spend_until_yesterday,
       {rd} AS remaining_days_in_month,
       {jdb} AS job_daily_budget,
       CAST(t.total_spend_sum AS DOUBLE) / CAST(NULLIF(c.budget, 0) AS DOUBLE) AS campaign_budget_util_rate,
       jd.clicks,
       CASE WHEN jd.clicks > 0 THEN {spend} / CAST(jd.clicks AS DOUBLE) END AS cpc,
       jd.applicants,
       CASE WHEN jd.clicks > 0 THEN CAST(jd.applicants AS DOUBLE) / CAST(jd.clicks AS DOUBLE) END
           AS conversion_rate,
       CASE WHEN jd.applicants > 0 THEN {spend} / CAST(jd.applicants AS DOUBLE) END AS cost_per_applicant,
       CASE WHEN jd.applicants > 0
            THEN ({spend} / CAST(jd.applicants AS DOUBLE)) / CAST(NULLIF(c.cpa_target, 0) AS DOUBLE) END
           AS cpa_target_rate,
       CASE WHEN {jdb} > 0 THEN {spend} / {jdb} END AS daily_budget_util_rate
FROM job_daily jd
JOIN totals t ON jd.company_name = t.company_name AND jd.date = t.date
JOIN {campaigns} c ON jd.company_name = c.company_name
"""


def create_performance_view(spark: SparkSession, name: str = "campaign_daily_performance",
                            **tables: str) -> DataFrame:
    """The mart as a temp view over registered tables."""
    df = spark.sql(performance_sql(**tables))
    df.createOrReplaceTempView(name)
    return df
