"""Queries over scopes that build on one another: carried windows, merged audits; keyword tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from adpulse import fixtures as fx
from adpulse.operators import audit_days, carry, keywords, search
from adpulse.operators.performance import clicks_daily
from adpulse.plans.catalog import register
from adpulse.sources import sinks


@register("spend_carried", f"""
SELECT job_id, date, CAST(sum(money) OVER (PARTITION BY job_id ORDER BY date
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE) AS spend_until_yesterday
FROM (SELECT job_id, date, sum(cost) AS money FROM ({fx.lineitem_as_clicks_sql()}) GROUP BY job_id, date)""")
def spend_carried(spark, sf_dir):
    """W4 over three scopes of years, each from the totals stored at the end of the one before."""
    base = sinks.scratch_path(spark, "spend-carried")
    daily = clicks_daily(fx.lineitem_as_clicks(spark, sf_dir))
    year = F.year("date")
    for scope, rows in (("1992", year < 1994), ("1994", (year >= 1994) & (year < 1996)), ("1996", year >= 1996)):
        carry.run_scope(daily.filter(rows), base, scope,
                        lambda df, opening: carry.running_sum(df, ["job_id"], ["date"], "spend_sum", opening),
                        lambda df, opening: carry.closing_totals(df, ["job_id"], "spend_sum", opening))
    return carry.read_scopes(spark, base).select("job_id", "date", F.col("running").cast("double").alias("spend_until_yesterday"))


_GAPS = """SELECT event_id, event_type, CASE WHEN event_id % 4 = 0 OR event_type = 'click' AND event_id % 50 <> 1 THEN NULL
           ELSE ts END AS created FROM events"""


@register("fill_carried", f"""
SELECT event_id, event_type, last_value(created IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS created
FROM ({_GAPS})""")
def fill_carried(spark, sf_dir):
    """W1 over three scopes of ids, each from the last values stored at the end of the one before."""
    base = sinks.scratch_path(spark, "fill-carried")
    events = fx.table(spark, sf_dir, "events")
    gap = (F.col("event_id") % 4 == 0) | (F.col("event_type") == "click") & (F.col("event_id") % 50 != 1)
    rows = events.select("event_id", "event_type", F.when(~F.coalesce(gap, F.lit(False)), F.col("ts")).alias("created"))
    third = F.floor(F.col("event_id") * 3 / (events.agg(F.max("event_id")).scalar() + 1))
    for n in range(3):
        carry.run_scope(rows.filter(third == n), base, f"part-{n}",
                        _filled, _last_values)
    return carry.read_scopes(spark, base)


def _filled(df, opening):
    return carry.fill_on(df, "created", "event_id", ["event_type"], opening=opening)


def _last_values(df, opening):
    return carry.closing_values(df, "created", "event_id", ["event_type"], opening=opening)


@register("keyword_table", """
WITH words AS (SELECT DISTINCT lower(trim(CASE WHEN p_partkey % 2 = 0 THEN split_part(p_name, ' ', 1) ELSE p_name END)) AS keyword
               FROM part),
listed AS (SELECT keyword FROM words WHERE keyword <> '' UNION SELECT 'license' UNION SELECT 'of the' UNION SELECT 'qz')
SELECT doc_id, coalesce((SELECT bool_or(contains(lower(text), keyword)) FROM listed), false) AS has_keyword
FROM documents""")
def keyword_table(spark, sf_dir):
    """P17 with the parts' names as keywords (single words and phrases) over whole texts."""
    name = F.when(F.col("p_partkey") % 2 == 0, F.split_part("p_name", F.lit(" "), F.lit(1))).otherwise(F.col("p_name"))
    listed = fx.table(spark, sf_dir, "part").select(F.trim(name).alias("keyword"))
    listed = listed.unionByName(spark.range(1).select(F.explode(F.array(*map(F.lit, ("License", "of the", "QZ")))).alias("keyword")))
    return keywords.keyword_flags(fx.table(spark, sf_dir, "documents"), listed).select("doc_id", "has_keyword")


@register("audit_merged", f"""
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, count(*) AS rows,
       count(*) - count(user_id) AS null_user_id, count(*) - count(value) AS null_value,
       true AS distinct_in_bound, true AS median_in_bound
FROM events GROUP BY ALL""")
def audit_merged(spark, sf_dir):
    """A8 and A9 per day with sketches, merged to months: exact counts, and whether distinct users and the
    median lie within the stated bounds of a count over all rows."""
    events = (fx.table(spark, sf_dir, "events")
              .withColumns({"day": F.to_date("ts"), "year": F.year("ts"), "month": F.month("ts")}))
    days = sinks.materialize(audit_days.daily_audit(events, "day", ["user_id", "value"], ["value"]), "audits")
    months = audit_days.merge_audits(days.withColumns({"year": F.year("day"), "month": F.month("day")}), ["year", "month"])
    said = audit_days.audit_report(months).select("year", "month", "rows", "null_user_id", "null_value", "distinct_user_id",
                                                  F.get("quantiles_value", F.lit(0)).alias("__median"))
    median = said.select(F.col("year").alias("__y"), F.col("month").alias("__m"), "__median")
    exact = (events.join(median, F.col("year").eqNullSafe(F.col("__y")) & F.col("month").eqNullSafe(F.col("__m")))
             .groupBy(F.col("year").alias("__y"), F.col("month").alias("__m"))
             .agg(F.count_distinct("user_id").alias("__users"), F.count("value").alias("__n"),
                  F.count_if(F.col("value") < F.col("__median")).alias("__below"),
                  F.count_if(F.col("value") <= F.col("__median")).alias("__upto")))
    bound = F.lit(audit_days.RANK_ERROR)
    return (said.join(exact, F.col("year").eqNullSafe(F.col("__y")) & F.col("month").eqNullSafe(F.col("__m")))
            .select("year", "month", "rows", "null_user_id", "null_value",
                    (F.abs(F.col("distinct_user_id") - F.col("__users"))
                     <= F.lit(audit_days.DISTINCT_ERROR) * F.col("__users")).alias("distinct_in_bound"),
                    ((F.col("__n") == 0) | (F.col("__below") / F.col("__n") <= 0.5 + bound)
                     & (F.col("__upto") / F.col("__n") >= 0.5 - bound)).alias("median_in_bound")))


@register("latest_k_merged", """
WITH seen AS (SELECT user_id, (event_id // 2) % 5000 AS ad, max(ts) AS ts FROM events GROUP BY ALL)
SELECT user_id, ad, ts, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, ad DESC) AS INTEGER) AS rank FROM seen)
WHERE rank <= 20""")
def latest_k_merged(spark, sf_dir):
    """O3 over three landings: each is merged with the 20 that the ones before have left."""
    ads = fx.table(spark, sf_dir, "events").select(
        "user_id", F.expr("(event_id div 2) % 5000").alias("ad"), F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id")
    order = [F.col("ts").desc(), F.col("ad").desc()]
    kept = ads.limit(0).drop("event_id")
    for day in range(3):
        landed = ads.filter(F.pmod("event_id", F.lit(3)) == day).drop("event_id")
        kept = sinks.materialize(search.merge_latest(kept, landed, ["user_id"], "ad", order), f"latest-{day}")
    return kept
