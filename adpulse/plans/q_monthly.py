"""Monthly queries: campaigns (C6 and parts), jobs (C5), dedup and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from adpulse import fixtures as fx
from adpulse.functions.keyed_random import SqlDraws
from adpulse.operators import campaigns as camp
from adpulse.operators import clean, dq
from adpulse.operators.jobs import monthly_jobs
from adpulse.operators.numbering import assign_ids
from adpulse.operators.synthetic import BUDGET_CHOICES, MARGIN_CHOICES
from adpulse.plans.catalog import register

# Old campaigns (fixture): the odd-numbered brands' keys of F1-with-nulls,
# id = 5000 + the group's smallest part key.
_OLD_FILTER = "company_name IS NOT NULL AND CAST(substr(company_name, 7) AS INTEGER) % 2 = 1"


def _old_campaigns(spark, sf_dir):
    ads = fx.parts_as_ads(spark, sf_dir, with_nulls=True)
    return (ads.filter(F.expr(_OLD_FILTER)).groupBy("company_name", "state")
            .agg((F.min("job_id") + F.lit(5000)).cast("long").alias("campaign_id"))
            .select("campaign_id", "company_name", "state", F.lit(50).alias("cpa_target"),
                    F.lit(10000).alias("budget"), F.lit(0.4).alias("margin")))


def _old_sql() -> str:
    return (f"SELECT CAST(min(job_id) + 5000 AS BIGINT) AS campaign_id, company_name, state, "
            f"50 AS cpa_target, 10000 AS budget, 0.4::DOUBLE AS margin "
            f"FROM ({fx.parts_as_ads_sql(True)}) WHERE {_OLD_FILTER} GROUP BY company_name, state")


_ADS_NULL = fx.parts_as_ads_sql(True)
_CTE = f"WITH ads AS ({_ADS_NULL}), old AS ({_old_sql()})"
_NOT_OLD = ("NOT EXISTS (SELECT 1 FROM old o WHERE o.company_name IS NOT DISTINCT FROM a.company_name "
            "AND o.state IS NOT DISTINCT FROM a.state)")
_MAX_ID = "(SELECT COALESCE(NULLIF(max(campaign_id), 0), 1000) FROM old)"


@register("avg_bid_by_campaign", f"""
SELECT company_name, state, avg(bid) AS avg_bid FROM ({_ADS_NULL}) GROUP BY company_name, state""")
def avg_bid_by_campaign(spark, sf_dir):
    return camp.avg_bid_by_campaign(fx.parts_as_ads(spark, sf_dir, with_nulls=True))


@register("max_id_or_default", f"""
{_CTE} SELECT CAST(COALESCE(NULLIF(max(campaign_id), 0), 1000) AS BIGINT) AS max_id FROM old""")
def max_id_or_default(spark, sf_dir):
    return camp.max_id_or_default(_old_campaigns(spark, sf_dir))


@register("new_keys_anti", f"""
{_CTE}
SELECT a.company_name, a.state, a.avg_bid
FROM (SELECT company_name, state, avg(bid) AS avg_bid FROM ads GROUP BY company_name, state) a
WHERE {_NOT_OLD}""")
def new_keys_anti(spark, sf_dir):
    agg = camp.avg_bid_by_campaign(fx.parts_as_ads(spark, sf_dir, with_nulls=True))
    return camp.new_keys(agg, _old_campaigns(spark, sf_dir))


@register("assign_ids", f"""
{_CTE}
SELECT CAST({_MAX_ID} + row_number() OVER (ORDER BY company_name NULLS FIRST, state NULLS FIRST) AS BIGINT)
           AS campaign_id, company_name, state
FROM (SELECT DISTINCT company_name, state FROM ads) a
WHERE {_NOT_OLD}""")
def assign_ids_query(spark, sf_dir):
    old = _old_campaigns(spark, sf_dir)
    keys = fx.parts_as_ads(spark, sf_dir, with_nulls=True).select("company_name", "state").distinct()
    fresh = camp.new_keys(keys, old)
    base = camp.max_id_or_default(old).scalar()
    return assign_ids(fresh, ["company_name", "state"], base).select("campaign_id", "company_name", "state")


@register("keep_lowest_id", f"""
{_CTE} SELECT * FROM old""")
def keep_lowest_id(spark, sf_dir):
    """Old campaigns plus a second copy of every key with a higher id and
    other values: the lowest id (the original row) must survive."""
    old = _old_campaigns(spark, sf_dir)
    dup = old.withColumns({"campaign_id": F.col("campaign_id") + 7, "budget": F.lit(1),
                           "margin": F.lit(0.9)})
    return camp.keep_lowest_id(old.unionByName(dup))


def _campaigns_sql(cte: str = _CTE) -> str:
    cpa = SqlDraws("cpa", ["company_name", "state"], normals=1)
    plan = SqlDraws("plan", ["company_name", "state"], uniforms=2)
    budget = SqlDraws.choice(plan.uniform(0, "hp"), BUDGET_CHOICES)
    margin = SqlDraws.choice(plan.uniform(1, "hp"), MARGIN_CHOICES)
    return f"""
{cte},
agg AS (SELECT company_name, state, avg(bid) AS avg_bid FROM ads
        WHERE company_name IS NOT NULL GROUP BY company_name, state),
fresh AS (SELECT a.*, CAST({_MAX_ID} + row_number() OVER (ORDER BY company_name NULLS FIRST,
                      state NULLS FIRST) AS BIGINT) AS campaign_id
          FROM agg a WHERE {_NOT_OLD}),
drawn AS (SELECT *, {cpa.hash_select('hc')}, {plan.hash_select('hp')} FROM fresh)
SELECT campaign_id, company_name, state,
       CAST(trunc(avg_bid * ({cpa.normal(0, 'hc')} * 3.0::DOUBLE + 30.0::DOUBLE)) AS INTEGER) AS cpa_target,
       CAST({budget} AS INTEGER) AS budget, CAST({margin} AS DOUBLE) AS margin
FROM drawn
UNION ALL
SELECT campaign_id, company_name, state, cpa_target, budget, margin FROM old"""


@register("campaigns_incremental", _campaigns_sql())
def campaigns_incremental(spark, sf_dir):
    ads = fx.parts_as_ads(spark, sf_dir, with_nulls=True)
    return camp.campaigns_incremental(_old_campaigns(spark, sf_dir), ads)


@register("campaigns_first_run", _campaigns_sql().replace(
    f"old AS ({_old_sql()})", f"old AS (SELECT * FROM ({_old_sql()}) WHERE false)"))
def campaigns_first_run(spark, sf_dir):
    """C6 with no previous table: ids start at 1001."""
    return camp.campaigns_incremental(None, fx.parts_as_ads(spark, sf_dir, with_nulls=True))


# The same over keys that grow with the data (a key per customer and priority), from an empty table.
_WIDE_CTE = f"WITH ads AS ({fx.orders_as_ads_sql()}), old AS (SELECT * FROM ({_old_sql()}) WHERE false)"


@register("campaigns_wide", _campaigns_sql(_WIDE_CTE))
def campaigns_wide(spark, sf_dir):
    return camp.campaigns_incremental(None, fx.orders_as_ads(spark, sf_dir))


@register("assign_ids_wide", f"""
{_WIDE_CTE}
SELECT CAST(1000 + row_number() OVER (ORDER BY company_name NULLS FIRST, state NULLS FIRST) AS BIGINT) AS campaign_id,
       company_name, state, n_ads
FROM (SELECT company_name, state, count(*) AS n_ads FROM ads GROUP BY company_name, state)""")
def assign_ids_wide(spark, sf_dir):
    """W2 with a payload column that the count of rows does not need."""
    keys = fx.orders_as_ads(spark, sf_dir).groupBy("company_name", "state").agg(F.count(F.lit(1)).alias("n_ads"))
    return assign_ids(keys, ["company_name", "state"], F.lit(1000).cast("long")).select(
        "campaign_id", "company_name", "state", "n_ads")


@register("dedup_wide", """
SELECT l_orderkey, l_shipdate, l_linenumber, l_partkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC) AS rn
  FROM lineitem) WHERE rn = 1""")
def dedup_wide(spark, sf_dir):
    """A7 with as many ids as there are orders."""
    lines = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_linenumber", "l_partkey")
    return clean.dedup_latest(lines, "l_orderkey", ("l_shipdate",))


# --- jobs, dedup, audits over F2 keyed by user (ids repeat) ----------------
_F2_DUP = fx.events_as_ads_sql(dup=True)
_F2 = fx.events_as_ads_sql()
_TIE = ["location_display_name", "country", "state", "county", "city", "latitude", "longitude",
        "contract_time", "contract_type", "category_tag", "category_label", "company_name",
        "title", "description", "salary_is_predicted", "salary_min", "salary_max", "redirect_url"]
_NEWEST = ", ".join(["created DESC NULLS LAST"] + [f"{c} DESC NULLS LAST" for c in _TIE])
_STAGE1_COLS = ("id, created, location_display_name, country, state, county, city, latitude, longitude, "
                "contract_time, contract_type, category_tag, category_label, company_name, title, "
                "description, salary_is_predicted, salary_min, salary_max, redirect_url")
_DEDUP_SQL = f"""
SELECT {_STAGE1_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY {_NEWEST}) AS rn FROM ({_F2_DUP})
) WHERE rn = 1"""


@register("dedup_by_id", _DEDUP_SQL)
def dedup_by_id(spark, sf_dir):
    return clean.dedup_latest(fx.events_as_ads(spark, sf_dir, dup=True), "id", ("created",))


@register("monthly_jobs", _DEDUP_SQL.replace("SELECT id,", "SELECT id AS job_id,", 1))
def monthly_jobs_query(spark, sf_dir):
    return monthly_jobs(fx.events_as_ads(spark, sf_dir, dup=True))


@register("dedup_audit", f"""
WITH f AS ({_F2_DUP})
SELECT CAST(count(*) AS BIGINT) AS rows_before,
       (SELECT count(*) FROM (SELECT DISTINCT id FROM f)) AS rows_after,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT id FROM f)) AS duplicates_removed
FROM f""")
def dedup_audit(spark, sf_dir):
    return dq.dedup_audit(fx.events_as_ads(spark, sf_dir, dup=True), "id")


_AUDIT_COLS = _STAGE1_COLS.split(", ")


@register("null_audit", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count, "
    f"count(*) FILTER (WHERE {c} IS NULL) > 0 AS has_nulls FROM ({_F2})" for c in _AUDIT_COLS))
def null_audit(spark, sf_dir):
    return dq.null_audit(fx.events_as_ads(spark, sf_dir), _AUDIT_COLS)
