import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from adpulse.operators import mart_delta as delta
from adpulse.operators.performance import MART_COLUMNS, job_daily, mart_rows, performance_mart
from adpulse.operators.skew import balanced_join, heavy_keys
from adpulse.sources import sinks

D = dt.date


def _frames(spark):
    campaigns = spark.createDataFrame(
        [(1001, "Acme", "CA", 10, 100, 0.3), (1002, "Acme", "TX", 0, 100, 0.4)],
        "campaign_id long, company_name string, state string, cpa_target int, budget int, margin double")
    jobs = spark.createDataFrame([("j1", "T1", "LA", "Acme", "CA"), ("j2", "T2", "SF", "Acme", "CA")],
                                 "job_id string, title string, city string, company_name string, state string")
    clicks = spark.createDataFrame(
        [("j1", D(2025, 8, 30), Decimal("2.00"), 1), ("j1", D(2025, 8, 30), Decimal("3.00"), 0),
         ("j1", D(2025, 8, 31), Decimal("60.00"), 0), ("j2", D(2025, 8, 31), Decimal("1.50"), 0)],
        "job_id string, date date, cost decimal(12,2), is_applicant int")
    return campaigns, jobs, clicks


def test_mart_semantics(spark):
    m = performance_mart(*_frames(spark))
    assert m.columns == MART_COLUMNS
    rows = {(r.campaign_id, r.job_id, r.date): r for r in m.collect()}
    # company-only join: each job is credited to both of Acme's campaigns
    assert len(rows) == 6
    first = rows[(1001, "j1", D(2025, 8, 30))]
    assert first.spend_until_yesterday is None and first.spend == 5.0 and first.clicks == 2
    assert first.remaining_days_in_month == 2 and first.budget_per_job == 100.0
    assert first.job_daily_budget == 50.0 and first.cpa_target_rate == 0.5
    second = rows[(1001, "j1", D(2025, 8, 31))]
    assert second.spend_until_yesterday == 5.0 and second.remaining_days_in_month == 1
    assert second.budget_per_job == 50.0 and second.total_spend == 61.5
    # zero applicants: cost per applicant undefined
    assert second.cost_per_applicant is None and second.conversion_rate == 0.0
    # cpa_target 0: the ratio is undefined, not infinite
    assert rows[(1002, "j1", D(2025, 8, 30))].cpa_target_rate is None
    # day two: budget left after yesterday over the remaining day
    neg = rows[(1001, "j1", D(2025, 8, 31))]
    assert neg.job_daily_budget == 45.0 and neg.daily_budget_util_rate == 60.0 / 45.0


def test_mart_match_state_restricts_fan_out(spark):
    m = performance_mart(*_frames(spark), match_state=True)
    assert {r.campaign_id for r in m.collect()} == {1001}


def test_materialized_and_recomputed_paths_agree(spark):
    for match_state in (False, True):
        a = performance_mart(*_frames(spark), match_state=match_state, materialize=True).collect()
        b = performance_mart(*_frames(spark), match_state=match_state, materialize=False).collect()
        assert sorted(a) == sorted(b) and a


def test_incremental_mart_equals_a_rebuild_and_rewrites_only_what_changed(spark):
    campaigns, jobs, clicks = _frames(spark)
    schema = clicks.schema
    base = sinks.scratch_path(spark, "delta")
    first = spark.createDataFrame([("j1", D(2025, 8, d), Decimal("2.00"), d % 2) for d in (1, 5, 9)]
                                  + [("j2", D(2025, 8, d), Decimal("1.00"), 0) for d in (2, 5, 8)], schema)
    assert delta.refresh_mart(campaigns, jobs, base, 0, first) == [D(2025, 8, d) for d in (1, 2, 5, 8, 9)]

    def same(now):
        got = sorted(delta.read_mart(spark, base, MART_COLUMNS).collect())
        assert got == sorted(performance_mart(campaigns, jobs, now).collect()) and got

    def written():
        return {f.split("date=")[1][:10]: f for f in spark.read.parquet(f"{base}/performance").inputFiles()}
    same(first)
    before = written()
    # A late click of j2 on the 3rd, a corrected one on the 5th, the only one of the 8th removed.
    added = spark.createDataFrame([("j2", D(2025, 8, 3), Decimal("4.00"), 1), ("j2", D(2025, 8, 5), Decimal("7.00"), 0)], schema)
    removed = spark.createDataFrame([("j2", D(2025, 8, 5), Decimal("1.00"), 0), ("j2", D(2025, 8, 8), Decimal("1.00"), 0)], schema)
    now = first.unionByName(added).exceptAll(removed)
    for _ in range(2):  # a batch taken again changes nothing
        assert delta.refresh_mart(campaigns, jobs, base, 1, added, removed) == [D(2025, 8, d) for d in (3, 5, 8)]
        same(now)
    after = written()
    assert set(after) == {"2025-08-01", "2025-08-02", "2025-08-03", "2025-08-05", "2025-08-09"}
    assert {d for d in before if after.get(d) == before[d]} == {"2025-08-01", "2025-08-02", "2025-08-09"}
    # Nothing new: nothing is touched.
    none = spark.createDataFrame([], schema)
    assert delta.refresh_mart(campaigns, jobs, base, 2, none) == []
    assert written() == after


def test_a_batch_stores_its_changes_once_and_the_first_sums_nothing_again(spark, monkeypatch):
    campaigns, jobs, clicks = _frames(spark)
    base, stored = sinks.scratch_path(spark, "delta"), []
    monkeypatch.setattr(sinks, "materialize", lambda df, name, keep=sinks.materialize: stored.append(name) or keep(df, name))
    delta.refresh_mart(campaigns, jobs, base, 4, clicks)
    assert "changes" not in stored and "daily" not in stored
    delta.refresh_mart(campaigns, jobs, base, 4, clicks)  # taken again
    assert "daily" not in stored
    assert sorted(delta.read_mart(spark, base, MART_COLUMNS).collect()) == sorted(performance_mart(campaigns, jobs, clicks).collect())
    delta.refresh_mart(campaigns, jobs, base, 5, clicks)
    assert "changes" not in stored and "daily" in stored
    twice = clicks.unionByName(clicks)
    assert sorted(delta.read_mart(spark, base, MART_COLUMNS).collect()) == sorted(performance_mart(campaigns, jobs, twice).collect())


@pytest.mark.parametrize("match_state", [False, True])
def test_balanced_mart_equals_the_plain_one(spark, match_state):
    campaigns, jobs, clicks = _frames(spark)
    jd = job_daily(jobs, clicks, match_state)
    plain = mart_rows(jd, campaigns, match_state)
    assert sorted(mart_rows(jd, campaigns, match_state, balanced=True, per_task=1).collect()) == sorted(plain.collect())


def test_rows_for_folders_are_sorted_before_they_are_copied_per_campaign(spark):
    campaigns, jobs, clicks = _frames(spark)
    days = sinks.materialize(job_daily(jobs, clicks), "days")
    rows = mart_rows(days, campaigns, balanced=True, by=["date"])
    # As a write in folders asks for it: what lies below the join is in order already.
    plan = rows.sortWithinPartitions("date")._jdf.queryExecution().executedPlan().toString()
    assert [op for op in re.findall(r"BroadcastHashJoin|Sort \[date", plan)][:2] == ["BroadcastHashJoin", "Sort [date"], plan
    assert sorted(rows.collect()) == sorted(mart_rows(days, campaigns).collect())


def test_a_hot_key_is_spread_without_the_run_time_skew_join(spark):
    n = 30_000
    left = spark.range(n).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).cast("int").alias("k"))
    left = sinks.materialize(left.withColumn("k", F.when(F.col("k") == 7, None).otherwise(F.col("k"))), "left")
    right = sinks.materialize(spark.range(2000).select((F.col("id") % 500).cast("int").alias("k"), F.col("id").alias("r")), "right")
    conf = {"spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        sizes = {}
        for name, df in (("plain", left.join(right, ["k"])), ("balanced", balanced_join(left, right, ["k"], ["id"], per_task=500))):
            per = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
            sizes[name] = sorted(r["count"] for r in per)
            assert sum(sizes[name]) == left.filter("k is not null").count() * 4
        assert sizes["plain"][-1] > 3 * sizes["plain"][len(sizes["plain"]) // 2]
        assert sizes["balanced"][-1] <= 3 * sizes["balanced"][len(sizes["balanced"]) // 2]
        heavy = heavy_keys(left, right, ["k"], per_task=500).collect()
        assert [r.k for r in heavy] == [0] and heavy[0].salts >= 80
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
