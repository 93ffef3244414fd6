"""Queries over periods (J2 with an end date) and over tables that lie together."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from adpulse import fixtures as fx
from adpulse.operators.intervals import overlap_join
from adpulse.operators.performance import clicks_daily
from adpulse.plans.catalog import register
from adpulse.sources import bucketed, sinks

# A tenth of all rows on one company; open ends, missing starts, ends before starts, and
# periods that span everything.
_CAMPAIGNS = {
    "company": "CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE o_custkey END",
    "campaign_id": "o_orderkey",
    "campaign_start": ("CASE WHEN o_orderkey % 1009 = 0 THEN DATE '1990-01-01' WHEN o_orderkey % 89 = 0 THEN NULL "
                       "ELSE CAST(o_orderdate AS DATE) END"),
    "campaign_end": ("CASE WHEN o_orderkey % 1009 = 0 THEN DATE '2030-01-01' WHEN o_orderkey % 97 = 0 THEN NULL "
                     "ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 - 1 AS INT) END"),
}
_JOBS = {
    "company": "CASE WHEN l_orderkey % 10 = 0 THEN 1 ELSE l_suppkey END",
    "job_id": "l_orderkey * 10 + l_linenumber",
    "job_start": "CAST(l_shipdate AS DATE)",
    "job_end": "CASE WHEN l_orderkey % 211 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) + CAST(l_partkey % 45 AS INT) END",
}


def _sql(exprs: dict[str, str], table: str) -> str:
    return f"SELECT {', '.join(f'{e} AS {n}' for n, e in exprs.items())} FROM {table}"


@register("period_overlap", f"""
WITH c AS ({_sql(_CAMPAIGNS, 'orders')}), j AS ({_sql(_JOBS, 'lineitem')}),
m AS (SELECT greatest((SELECT max(greatest(campaign_start, campaign_end)) FROM c),
                      (SELECT max(greatest(job_start, job_end)) FROM j)) AS last),
c2 AS (SELECT company, campaign_id, campaign_start AS cs, coalesce(campaign_end, last) AS ce FROM c, m),
j2 AS (SELECT company, job_id, job_start AS js, coalesce(job_end, last) AS je FROM j, m)
SELECT campaign_id, count(*) AS jobs, min(job_id) AS first_job,
       CAST(sum(least(ce, je) - greatest(cs, js) + 1) AS BIGINT) AS shared_days
FROM c2 JOIN j2 USING (company) WHERE cs <= ce AND js <= je AND cs <= je AND js <= ce GROUP BY campaign_id""")
def period_overlap(spark, sf_dir):
    """Jobs that run during each campaign of their company, and the days they share."""
    orders, items = (fx.table(spark, sf_dir, t) for t in ("orders", "lineitem"))
    campaigns = orders.select(*(F.expr(e).alias(n) for n, e in _CAMPAIGNS.items()))
    jobs = items.select(*(F.expr(e).alias(n) for n, e in _JOBS.items()))
    last = F.greatest(campaigns.agg(F.max(F.greatest("campaign_start", "campaign_end"))).scalar(),
                      jobs.agg(F.max(F.greatest("job_start", "job_end"))).scalar())
    # Rows of a company with the same period meet the same rows, so periods are joined as classes:
    # the pairs of a hot company follow its different periods, not the square of its rows.
    campaigns = campaigns.withColumn("campaign_end", F.coalesce("campaign_end", last))
    jobs = jobs.withColumn("job_end", F.coalesce("job_end", last))
    period = ["company", "campaign_start", "campaign_end"]
    running = sinks.materialize(jobs.groupBy("company", "job_start", "job_end").agg(
        F.count(F.lit(1)).alias("n"), F.min("job_id").alias("first")), "job-periods")
    pairs = overlap_join(sinks.materialize(campaigns.select(*period).distinct(), "campaign-periods"), running, ["company"],
                         ("campaign_start", "campaign_end"), ("job_start", "job_end"))
    shared = F.datediff(F.least("campaign_end", "job_end"), F.greatest("campaign_start", "job_start")) + 1
    met = pairs.groupBy(*period).agg(F.sum("n").alias("jobs"), F.min("first").alias("first_job"),
                                     F.sum(shared * F.col("n")).alias("shared_days"))
    return campaigns.join(met, period).groupBy("campaign_id").agg(
        F.sum("jobs").alias("jobs"), F.min("first_job").alias("first_job"), F.sum("shared_days").alias("shared_days"))


@register("job_spend_bucketed", f"""
WITH paid AS (SELECT job_id, date, sum(cost) AS money, count(*) AS clicks, sum(is_applicant) AS hired
              FROM ({fx.lineitem_as_clicks_sql()}) GROUP BY job_id, date)
SELECT job_id, date, title, city, company_name, CAST(money AS DOUBLE) AS spend, clicks, CAST(hired AS BIGINT) AS applicants,
       CAST(sum(money) OVER (PARTITION BY job_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
            AS DOUBLE) AS spend_until_yesterday
FROM paid JOIN ({fx.jobs_from_parts_sql()}) USING (job_id)""")
def job_spend_bucketed(spark, sf_dir):
    """A4, J3 and W4 over jobs and clicks bucketed by job_id: one shuffle, when they are written."""
    clicks, jobs = fx.lineitem_as_clicks(spark, sf_dir), fx.jobs_from_parts(spark, sf_dir)
    n = bucketed.buckets_for(clicks.count())
    run = uuid.uuid4().hex
    clicks, jobs = (bucketed.write_bucketed(df, f"{name}_{run}", sinks.scratch_path(spark, f"bucketed-{name}"), "job_id", n)
                    for name, df in (("clicks", clicks), ("jobs", jobs)))
    before = Window.partitionBy("job_id").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    return clicks_daily(clicks).join(jobs, "job_id").select(
        "job_id", "date", "title", "city", "company_name", F.col("spend_sum").cast("double").alias("spend"), "clicks",
        "applicants", F.sum("spend_sum").over(before).cast("double").alias("spend_until_yesterday"))
