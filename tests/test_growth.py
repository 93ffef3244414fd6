"""Figures that must not grow faster than the input: shuffles, pairs, passes over the same rows."""

import datetime as dt
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

from adpulse.operators import clicks, intervals, keywords, rescue
from adpulse.operators import performance as perf
from adpulse.plans import catalog, q_mart, q_periods
from adpulse.sources import sinks


def test_days_dealt_out_before_they_are_made(spark):
    rows = [("a", dt.date(2024, 1, 1)), ("a", dt.date(2024, 1, 1)), ("b", dt.date(2024, 3, 31)), ("c", dt.date(2024, 2, 29)),
            ("d", dt.date(2024, 4, 3)), ("e", dt.date(2024, 4, 2)), ("f", None), (None, dt.date(2024, 3, 1))]
    jobs = spark.createDataFrame([(i, d, 1.0) for i, d in rows], "job_id string, created_date date, bid double")
    # 94 days are three pieces; none is lost or made twice at their borders.
    assert Counter(map(tuple, clicks.job_days(jobs, 5).collect())) == Counter(map(tuple, clicks.job_days(jobs).collect()))
    above = clicks.generate_clicks(jobs, num_partitions=5)._jdf.queryExecution().executedPlan().toString().split("Exchange")[0]
    assert above.count("explode(") == 2  # days and clicks: only pieces are shuffled


def test_rows_of_one_period_are_joined_once(spark, tmp_path, monkeypatch):
    day = dt.datetime(1995, 5, 1)
    orders = [(300 * (i % 40) + 20, 7, day) for i in range(44)] + [(21, 3, day), (22, None, day), (23, 3, None)]
    items = [(10 * i, i % 3, 5, 45, day + dt.timedelta(days=3)) for i in range(50)] + [(11, 1, 3, 5, day), (12, 1, None, 5, day)]
    for name, rows, kinds in (("orders", orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
                              ("lineitem", items, "l_orderkey long, l_linenumber int, l_suppkey long, l_partkey long, l_shipdate timestamp_ntz")):
        spark.createDataFrame(rows, kinds).write.parquet(f"{tmp_path}/{name}.parquet")
    met = []
    join = q_periods.overlap_join

    def counted(*args, **options):
        met.append(join(*args, **options))
        return met[-1]
    monkeypatch.setattr(q_periods, "overlap_join", counted)
    got = sorted((r.asDict() for r in q_periods.period_overlap(spark, str(tmp_path)).collect()), key=lambda r: r["campaign_id"])
    views = {t: duckdb.read_parquet(f"{tmp_path}/{t}.parquet/*.parquet") for t in ("orders", "lineitem")}
    orders, lineitem = views["orders"], views["lineitem"]  # noqa: F841 - named in the statement
    want = duckdb.sql(catalog.ORACLES["period_overlap"]).df().sort_values("campaign_id").to_dict("records")
    assert got == want and len(got) > 30 and any(r["jobs"] > 50 for r in got)
    assert met[0].count() < 40  # the rows have 2,000 pairs
    assert met[0].columns[0] == "company"


def test_periods_without_a_partner_are_not_copied(spark, monkeypatch):
    stored = {}
    keep = intervals.sinks.materialize

    def seen(df, name):
        stored[name] = keep(df, name)
        return stored[name]
    monkeypatch.setattr(intervals.sinks, "materialize", seen)
    left = spark.createDataFrame([(1, "a", 0, 5000), (2, "b", 3, 4)], "i int, k string, s int, e int")
    right = spark.createDataFrame([(j, "b" if j % 2 else "c", j, j + 1) for j in range(50)], "j int, k string, s2 int, e2 int")
    got = intervals.overlap_join(left, right, ["k"], ("s", "e"), ("s2", "e2"))
    assert {(r.i, r.j) for r in got.collect()} == {(2, 3)}
    rows = stored["periods-right"]
    assert rows.filter("k = 'c'").count() == 0 and rows.filter("__level > 8").count() == 0


def test_drift_parses_a_line_a_fixed_number_of_times(spark):
    lines = spark.createDataFrame([('{"id":"1","title":{"a":1},"x":1,"x":2}',), ('{"id":"2","id":{"b":[1]},"created":"no"}',),
                                   ('{"id":"3","title":null,"y":null}',), ("{",), ("{}",)], "value string")
    good, _ = rescue.rescue_lines(lines)
    report = rescue.drift_report(good)
    assert sorted(map(tuple, report.collect())) == [("created", "mistyped", 1, "STRING"), ("id", "mistyped", 1, "OBJECT<b: ARRAY<BIGINT>>"),
                                                    ("title", "mistyped", 1, "OBJECT<a: BIGINT>"), ("x", "unknown", 1, "BIGINT")]
    # Parsed for the filter of broken lines, for the fields and for the typed column: not once per field.
    assert report._jdf.queryExecution().optimizedPlan().toString().count("from_json") <= 4


def test_only_grams_of_keywords_are_stored(spark, monkeypatch):
    stored = {}
    keep = keywords.materialize

    def seen(df, name):
        stored[name] = keep(df, name)
        return stored[name]
    monkeypatch.setattr(keywords, "materialize", seen)
    texts = spark.createDataFrame([(i, f"word{i} bonus pay{i} health care") for i in range(60)] + [(99, None)], "id int, text string")
    listed = spark.createDataFrame([("Bonus",), ("health care",), ("zz",), (None,)], "keyword string")
    hits = keywords.keyword_hits(texts, listed)
    assert hits.groupBy("keyword").count().rdd.collectAsMap() == {"bonus": 60, "health care": 60}
    grams = {r.gram for r in stored["word-grams"].collect()}
    assert grams <= {"bon", "onu", "nus", "hea", "eal", "alt", "lth", "zz"}


def _mart_frames(spark):
    campaigns = spark.createDataFrame([(k, f"c{k % 3}", f"s{k}", 20 if k else 0, 900, 0.5) for k in range(9)] + [(9, None, "s", 1, 1, 0.1)],
                                      "campaign_id long, company_name string, state string, cpa_target int, budget int, margin double")
    jobs = spark.createDataFrame([(j, f"t{j}", "x", f"c{j % 4}" if j % 5 else None, "s1") for j in range(20)],
                                 "job_id long, title string, city string, company_name string, state string")
    clicks = spark.createDataFrame([(j % 20, dt.date(2025, 8, 1 + j % 7), Decimal(j), j % 2) for j in range(300)] + [(None, None, None, None)],
                                   "job_id long, date date, cost decimal(12,2), is_applicant int")
    return campaigns, jobs, clicks


def test_mart_computes_a_day_once_for_all_campaigns(spark):
    campaigns, jobs, clicks = _mart_frames(spark)
    plan = perf.performance_mart(campaigns, jobs, clicks)._jdf.queryExecution().optimizedPlan().toString()
    assert "spend_sum" not in plan.split("Join")[0]  # no sum is cast again for each campaign


@pytest.mark.parametrize("few", [100_000, 3])
def test_mart_lies_together_by_date(spark, monkeypatch, few):
    monkeypatch.setattr(perf, "FEW_CAMPAIGNS", few)
    frames = _mart_frames(spark)
    plain = perf.performance_mart(*frames)
    mart = perf.performance_mart(*frames, materialize=True, by=["date"])
    assert Counter(map(tuple, mart.collect())) == Counter(map(tuple, plain.collect())) and mart.columns == perf.MART_COLUMNS
    above = mart._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert ("Rebalance" in above) == (few == 3)  # few campaigns: job-days are shuffled, not the rows


def test_mart_write_shuffles_no_fanned_out_rows(spark, tmp_path, monkeypatch):
    written = []
    put = sinks.write_swap

    def seen(df, path, cols=()):
        written.append(df)
        put(df, path, cols)
    monkeypatch.setattr(sinks, "write_swap", seen)
    parts = [(i, f"p{i}", f"b{i % 2}", f"t{i % 5}", 900.0 + i) for i in range(20)]
    items = [(i % 20, dt.datetime(1995, 1, 1 + i % 9), 10.5 * i, "RN"[i % 2]) for i in range(200)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double"
                          ).write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame(items, "l_partkey long, l_shipdate timestamp_ntz, l_extendedprice double, l_returnflag string"
                          ).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = q_mart.performance_mart_write(spark, str(tmp_path))
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, q_mart.performance_mart(spark, str(tmp_path)).collect()))
    above = written[-1]._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "Rebalance" not in above
