import datetime as dt
import math
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from adpulse.operators import campaigns as camp
from adpulse.operators import clean, clicks, dq, geo, search
from adpulse.operators.numbering import assign_ids, global_rank
from adpulse.schemas import CAMPAIGN_SCHEMA, CLICK_SCHEMA

TS = dt.datetime


def test_dedup_keeps_newest_and_collapses_null_ids(spark):
    rows = [("a", TS(2024, 1, 1), "x"), ("a", TS(2024, 1, 3), "y"), ("a", None, "z"),
            (None, TS(2024, 1, 1), "p"), (None, TS(2024, 1, 2), "q"), ("b", None, "only")]
    df = spark.createDataFrame(rows, "id string, created timestamp, v string")
    got = sorted((r.id or "", r.v) for r in clean.dedup_latest(df, "id", ("created",)).collect())
    assert got == [("", "q"), ("a", "y"), ("b", "only")]


def test_dedup_audit_counts_null_group_once(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "id string")
    r = dq.dedup_audit(df).first()
    assert (r.rows_before, r.rows_after, r.duplicates_removed) == (5, 3, 2)


def test_null_audit(spark):
    df = spark.createDataFrame([(1, None), (None, "x"), (3, None)], "a int, b string")
    got = {r.column_name: (r.null_count, r.has_nulls) for r in dq.null_audit(df).collect()}
    assert got == {"a": (1, True), "b": (2, True)}


def test_forward_fill_matches_window_across_blocks(spark):
    random.seed(3)
    rows = [(i, random.choice("xyz"), None if random.random() < 0.4 else i * 10) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, g string, v long")
    w = Window.partitionBy("g").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    want = {r.k: r.v for r in df.select("k", F.last("v", True).over(w).alias("v")).collect()}
    got = {r.k: r.v for r in clean.forward_fill(df, "v", "k", ["g"], n_blocks=7).collect()}
    assert got == want
    got = {r.k: r.v for r in clean.forward_fill(df, "v", "k", ["g"], n_blocks=13).collect()}
    assert got == want


def test_forward_fill_by_timestamp_blocks(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(minutes=7 * i), None if i % 3 else i) for i in range(200)]
    df = spark.createDataFrame(rows, "t timestamp, v long")
    got = {r.t: r.v for r in clean.forward_fill(df, "v", "t", n_blocks=9).collect()}
    assert got == {t: (i - i % 3) for i, (t, _) in enumerate(rows)}


def test_forward_fill_orders_by_text_too(spark):
    df = spark.createDataFrame([("b", None), ("a", 1), ("c", 2), ("d", None)], "k string, v int")
    got = {r.k: r.v for r in clean.forward_fill(df, "v", "k", n_blocks=3).collect()}
    assert got == {"a": 1, "b": 1, "c": 2, "d": 2}


def test_reference_fill_never_fills(spark):
    rows = [("1", TS(2024, 1, 2)), ("2", None), ("3", TS(2024, 1, 1)), ("4", None)]
    df = spark.createDataFrame(rows, "id string, created timestamp")
    got = {r.id: r.created for r in clean.fill_created_reference(df).collect()}
    assert got == dict(rows)


def test_global_rank_equals_row_number(spark):
    random.seed(5)
    keys = list({(random.choice(["a", "b", None, "c"]), random.randint(0, 400)) for _ in range(500)})
    df = spark.createDataFrame(keys, "c string, s int")
    got = {(r.c, r.s): r.rank for r in global_rank(df, ["c", "s"], num_partitions=5).collect()}
    ordered = sorted(keys, key=lambda k: (k[0] is not None, k[0] or "", k[1]))
    assert got == {k: i + 1 for i, k in enumerate(ordered)}


def test_assign_ids_start_after_base(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "y"), ("a", None)], "company_name string, state string")
    got = sorted((r.campaign_id, r.company_name, r.state) for r in assign_ids(df, ["company_name", "state"], 1000).collect())
    assert got == [(1001, "a", None), (1002, "a", "y"), (1003, "b", "x")]


def _ads(spark):
    rows = [("Acme", "CA", 2.0), ("Acme", "CA", 4.0), ("Acme", "TX", 1.0), ("Bolt", None, 3.0),
            (None, "NY", 5.0)]
    return spark.createDataFrame(rows, "company_name string, state string, bid double")


def test_campaigns_first_run_and_rerun_is_stable(spark):
    first = camp.campaigns_incremental(None, _ads(spark))
    assert [(f.name, f.dataType) for f in first.schema] == [(f.name, f.dataType) for f in CAMPAIGN_SCHEMA]
    rows = sorted(first.collect(), key=lambda r: r.campaign_id)
    assert [(r.campaign_id, r.company_name, r.state) for r in rows] == \
        [(1001, "Acme", "CA"), (1002, "Acme", "TX"), (1003, "Bolt", None)]
    assert all(r.budget in (5000, 6250, 7500, 8750, 10000, 11250, 12500, 15000) for r in rows)
    assert all(r.margin in (0.3, 0.35, 0.4, 0.45) for r in rows)
    again = camp.campaigns_incremental(spark.createDataFrame(rows, CAMPAIGN_SCHEMA), _ads(spark))
    assert sorted(again.collect()) == sorted(rows)


def test_campaigns_new_key_appended_after_max(spark):
    old = spark.createDataFrame([(1005, "Acme", "CA", 60, 5000, 0.3)], CAMPAIGN_SCHEMA)
    got = sorted((r.campaign_id, r.company_name, r.state)
                 for r in camp.campaigns_incremental(old, _ads(spark)).collect())
    assert got == [(1005, "Acme", "CA"), (1006, "Acme", "TX"), (1007, "Bolt", None)]


def test_campaigns_compat_reproduces_id_holes(spark):
    old = camp.campaigns_incremental(None, _ads(spark), compat=True)
    ids = sorted(r.campaign_id for r in old.collect())
    # the null company takes id 1001 before it is filtered out
    assert ids == [1002, 1003, 1004]


def test_keep_lowest_id(spark):
    rows = [(1, "A", None, 1, 1, 0.3), (5, "A", None, 2, 2, 0.4), (2, "B", "x", 3, 3, 0.3)]
    df = spark.createDataFrame(rows, CAMPAIGN_SCHEMA)
    assert sorted(r.campaign_id for r in camp.keep_lowest_id(df).collect()) == [1, 2]


def test_max_id_default(spark):
    empty = spark.createDataFrame([], CAMPAIGN_SCHEMA)
    assert camp.max_id_or_default(empty).first().max_id == 1000
    zero = spark.createDataFrame([(0, "A", "B", 1, 1, 0.3)], CAMPAIGN_SCHEMA)
    assert camp.max_id_or_default(zero).first().max_id == 1000


def _jobs(spark):
    rows = [("j1", dt.date(2025, 8, 1), 2.0), ("j2", dt.date(2025, 8, 5), 3.0),
            ("j3", None, 1.0), ("j4", dt.date(2025, 8, 5), 0.25)]
    return spark.createDataFrame(rows, "job_id string, created_date date, bid double")


def test_job_days_forms_agree(spark):
    a = sorted(clicks.job_days(_jobs(spark)).collect())
    b = sorted(clicks.job_days_range_join(_jobs(spark)).collect())
    assert a == b
    per_job = {}
    for r in a:
        per_job[r.job_id] = per_job.get(r.job_id, 0) + 1
    assert per_job == {"j1": 5, "j2": 1, "j4": 1}


def test_generated_clicks_properties(spark):
    c = clicks.generate_clicks(_jobs(spark))
    per_day = c.groupBy("job_id", "date").count().collect()
    assert all(10 <= r["count"] <= 80 for r in per_day)
    assert {r.job_id for r in per_day} == {"j1", "j2", "j4"}
    assert c.select("click_id").distinct().count() == c.count()
    assert c.filter(~F.col("time").rlike("^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$")).count() == 0
    again = clicks.generate_clicks(_jobs(spark).repartition(3))
    assert sorted(c.collect()) == sorted(again.collect())
    assert [(f.name, f.dataType) for f in c.schema] == [(f.name, f.dataType) for f in CLICK_SCHEMA]


def test_latest_k(spark):
    rows = [("s", i) for i in range(30)] + [("t", 1)]
    df = spark.createDataFrame(rows, "g string, v int")
    got = search.latest_k(df, ["g"], [F.col("v").desc()], 20).collect()
    assert sorted(r.v for r in got if r.g == "s") == list(range(10, 30))
    assert [r.v for r in got if r.g == "t"] == [1]


def test_search_grid(spark):
    places = spark.createDataFrame([("Texas", "Houston"), ("Ohio", "Akron")], "State string, City string")
    got = search.search_grid(places, ["A", "B"]).collect()
    assert len(got) == 4 and {r.Job_Title for r in got} == {"A", "B"}


def _brute(points, places, max_km):
    def hav(a, b):
        p1, p2 = math.radians(a[1]), math.radians(b[1])
        dphi, dl = p2 - p1, math.radians(b[0]) - math.radians(a[0])
        h = math.sin(dphi / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
        return 2 * 6371.0 * math.asin(math.sqrt(min(1.0, h)))
    out = {}
    for pid, lon, lat in points:
        best = min(((hav((lon, lat), (p[0], p[1])), p[2]) for p in places), default=None)
        out[pid] = best[1] if best and best[0] <= max_km else None
    return out


def test_reverse_geocode_equals_brute_force_with_wrap(spark):
    random.seed(11)
    places = [(random.uniform(-180, 180), random.uniform(-70, 70), f"c{i}") for i in range(300)]
    places += [(179.9, 10.0, "east"), (-179.95, 10.2, "west")]
    points = [(i, random.uniform(-180, 180), random.uniform(-70, 70)) for i in range(400)]
    points += [(1000, -179.99, 10.1), (1001, 179.99, 10.15)]
    pl = spark.createDataFrame([(lo, la, c, "co", "st", "us") for lo, la, c in places],
                               "longitude double, latitude double, city string, county string, state string, country string")
    pt = spark.createDataFrame(points, "point_id long, longitude double, latitude double")
    want = _brute(points, places, 60.0)
    got = {r.point_id: r.city for r in geo.reverse_geocode(pt, pl, max_km=60.0).collect()}
    assert got == want
    assert want[1000] in ("east", "west") and want[1001] in ("east", "west")


def test_fill_from_lookup_only_fills_nulls(spark):
    ads = spark.createDataFrame(
        [("1", 1.0, 2.0, None, "C", None, "US"), ("2", 1.0, 2.0, "Own", "C", "S", "US"),
         ("3", 9.0, 9.0, None, None, None, None)],
        "id string, longitude double, latitude double, city string, county string, state string, country string")
    places = spark.createDataFrame([(1.0, 2.0, None, "Town", "Road", "PC", "PS", "us")],
                                   "longitude double, latitude double, city string, town string, road string, county string, state string, country string")
    got = {r.id: (r.city, r.county, r.state, r.country) for r in geo.fill_from_lookup(ads, places).collect()}
    assert got == {"1": ("Town", "C", "PS", "US"), "2": ("Own", "C", "S", "US"), "3": (None, None, None, None)}


def test_native_mode_runs_and_respects_ranges(spark):
    c = clicks.generate_clicks(_jobs(spark), mode="native", seed=7)
    per_day = c.groupBy("job_id", "date").count().collect()
    assert per_day and all(10 <= r["count"] <= 80 for r in per_day)
    assert c.filter(~F.col("device_type").isin("Mobile", "PC")).count() == 0
    assert c.filter(~F.col("is_applicant").isin(0, 1)).count() == 0


def test_click_distributions(spark):
    rows = [(f"job{i}", dt.date(2025, 8, 1 + i % 20), 3.0) for i in range(300)]
    jobs = spark.createDataFrame(rows, "job_id string, created_date date, bid double")
    c = clicks.generate_clicks(jobs)
    per_day = c.groupBy("job_id", "date").count()
    m = per_day.agg(F.avg("count"), F.min("count"), F.max("count")).first()
    assert abs(m[0] - 45) < 1.5 and m[1] >= 10 and m[2] <= 80
    s = c.agg(F.avg("cost"), F.stddev("cost"), F.avg("is_applicant"),
              F.avg((F.col("device_type") == "Mobile").cast("int")),
              F.avg((F.col("gender") == "Male").cast("int")),
              F.countDistinct("age_group")).first()
    assert abs(s[0] - 3.0) < 0.02 and abs(s[1] - 0.5) < 0.02
    assert abs(s[2] - 0.15) < 0.01
    assert abs(s[3] - 0.5) < 0.02 and abs(s[4] - 0.5) < 0.02 and s[5] == 6


def test_empty_month_gives_empty_results(spark):
    jobs = spark.createDataFrame([], "job_id string, created_date date, bid double")
    assert clicks.generate_clicks(jobs).count() == 0
    assert clicks.job_days_range_join(jobs).count() == 0
    b = clicks.date_bounds(jobs).first()
    assert b.min_date is None and b.max_date is None
    ads = spark.createDataFrame([], "company_name string, state string, bid double")
    assert camp.campaigns_incremental(None, ads).count() == 0


def test_dates_all_null_give_no_clicks(spark):
    jobs = spark.createDataFrame([("j", None, 1.0)], "job_id string, created_date date, bid double")
    assert clicks.generate_clicks(jobs).count() == 0
