"""Period joins, rescued fields and bucketed tables against plain forms."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from adpulse.operators import rescue
from adpulse.operators.intervals import overlap_join
from adpulse.operators.skew import grid_join
from adpulse.schemas import RAW_SCHEMA
from adpulse.sources import bucketed, sinks


def _pairs(left, right, last):
    out = Counter()
    for i, k, s, e in left:
        for j, k2, s2, e2 in right:
            if None in (k, k2, s, s2) or k != k2:
                continue
            a, b = last if e is None else e, last if e2 is None else e2
            if s <= a and s2 <= b and s <= b and s2 <= a:
                out[i, j] += 1
    return out


def _frames(spark, left, right, kind="int"):
    return (spark.createDataFrame(left, f"i int, k string, s {kind}, e {kind}"),
            spark.createDataFrame(right, f"j int, k string, s2 {kind}, e2 {kind}"))


def _found(spark, left, right, kind="int", **options):
    a, b = _frames(spark, left, right, kind)
    got = overlap_join(a, b, ["k"], ("s", "e"), ("s2", "e2"), **options)
    assert got.columns == ["i", "k", "s", "e", "j", "s2", "e2"]
    return Counter((r.i, r.j) for r in got.collect())


def _some(rng, n, longest):
    rows = []
    for i in range(n):
        s = None if rng.random() < 0.05 else rng.randint(-60, 60)
        length = rng.choice([0, 0, 1, 2, 3, rng.randint(0, longest), -rng.randint(1, 3)])
        rows.append((i, rng.choice(["a", "a", "b", None]), s, None if s is None or rng.random() < 0.1 else s + length))
    return rows


@pytest.mark.parametrize(("seed", "per_task"), [(1, 1_000_000), (2, 20)])
def test_overlaps_equal_brute_force(spark, seed, per_task):
    rng = random.Random(seed)
    left, right = _some(rng, 90, 70), _some(rng, 120, 9)
    # One period over everything on either side, and rows that repeat.
    left += [(900, "a", -500, 500), left[0], left[0]]
    right += [(901, "a", -10_000, 10_000), right[1]]
    last = max(x for r in left + right for x in r[2:] if x is not None)
    assert _found(spark, left, right, per_task=per_task) == _pairs(left, right, last)


def test_dates_and_empty_sides(spark):
    day = dt.date(2025, 1, 1)
    left = [(1, "a", day, day), (2, "a", dt.date(1960, 5, 1), None), (3, "a", day, dt.date(2024, 12, 31))]
    right = [(1, "a", day, None), (2, "a", dt.date(1960, 4, 1), dt.date(1960, 5, 1)), (3, "b", day, day)]
    assert _found(spark, left, right, "date") == Counter({(1, 1): 1, (2, 1): 1, (2, 2): 1})
    assert not _found(spark, [], right, "date") and not _found(spark, left, [], "date")


def test_names_on_both_sides_and_columns_without_a_hash(spark):
    a, b = _frames(spark, [(1, "a", 1, 5)], [(1, "a", 2, 3)])
    with pytest.raises(ValueError, match="e2"):
        overlap_join(a.withColumn("E2", F.lit(1)), b, ["k"], ("s", "e"), ("s2", "e2"))
    rich = a.withColumns({"m": F.create_map("k", "s"), "v": F.parse_json(F.lit("[1]"))})
    assert overlap_join(rich, b, ["k"], ("s", "e"), ("s2", "e2"), per_task=0).count() == 1


def test_no_inequality_join(spark):
    a, b = _frames(spark, [(1, "a", 1, 5)], [(1, "a", 2, 3)])
    plan = overlap_join(a, b, ["k"], ("s", "e"), ("s2", "e2"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_grid_join_deals_out_the_larger_side(spark):
    left = spark.range(3000).selectExpr("if(id % 3 = 0, 0, id % 700) AS k", "id AS a")
    right = spark.range(900).selectExpr("if(id % 2 = 0, 1, id % 300) AS k", "id AS b")
    want = left.join(right, "k")
    got = grid_join(left, right, ["k"], ["a"], ["b"], per_task=100)
    assert got.columns == ["k", "a", "b"]
    assert Counter(got.collect()) == Counter(want.collect())


_LINES = [
    '{"id":"1","title":"a","latitude":1.5,"created":"2025-01-02T03:04:05Z"}',
    '{"id":2,"title":{"t":"b"},"remote":true,"it\'s":[1,2.50]}',
    '{"id":"3","created":"soon","title":null,"salary_min":null,"ID":"other","none":null}',
    '{"id":"4","title":["x"],"title":"last","more":1,"more":"two"}',
    '{"id":"5"', '[1]', '7', '', '   ', '{}',
]


def test_rescued_fields(spark):
    df = spark.createDataFrame([(i, line) for i, line in enumerate(_LINES)] + [(99, None)], "place int, value string")
    good, broken = rescue.rescue_lines(df)
    assert good.columns == ["place", *(f.name for f in RAW_SCHEMA.fields), "rescued"]
    path = sinks.scratch_path(spark, "rescued")
    good.write.parquet(path)  # variants are stored and read back
    good = spark.read.schema(good.schema).parquet(path)
    told = F.transform_values("rescued", lambda k, v: F.to_json(v))
    got = {r.place: r for r in good.withColumn("told", told).drop("rescued").collect()}
    assert sorted(got) == [0, 1, 2, 3, 9]
    assert {p: r.told for p, r in got.items()} == {
        0: None, 1: {"title": '{"t":"b"}', "remote": "true", "it's": "[1,2.5]"},
        2: {"created": '"soon"', "ID": '"other"'}, 3: {"more": '"two"'}, 9: None}
    assert (got[0].latitude, got[1].id, got[1].title, got[2].created, got[3].title, got[9].id) == ("1.5", "2", None, None, "last", None)
    assert got[0].created is not None
    assert sorted((r.place, r.line) for r in broken.collect()) == [(i, _LINES[i]) for i in (4, 5, 6)]
    report = {r.field: (r.reason, r.lines, r.type) for r in rescue.drift_report(good).collect()}
    assert report == {"title": ("mistyped", 1, "OBJECT<t: STRING>"), "remote": ("unknown", 1, "BOOLEAN"),
                      "it's": ("unknown", 1, "ARRAY<DECIMAL(21,1)>"), "created": ("mistyped", 1, "STRING"),
                      "ID": ("unknown", 1, "STRING"), "more": ("unknown", 1, "STRING")}


def test_rescue_refuses_clashing_names_and_takes_no_lines(spark):
    df = spark.createDataFrame([("x", "{}")], "title string, value string")
    with pytest.raises(ValueError, match="title"):
        rescue.rescue_lines(df)
    good, broken = rescue.rescue_lines(df.select("value").limit(0))
    assert good.count() == broken.count() == rescue.drift_report(good).count() == 0


def test_bucketed_tables_meet_without_a_shuffle(spark):
    clicks = spark.range(5000).selectExpr("if(id % 3 = 0, 7, id % 400) AS job_id", "id % 5 AS date", "id AS cost")
    clicks = clicks.unionByName(spark.createDataFrame([(None, 1, 2)], clicks.schema))
    jobs = spark.range(400).selectExpr("id AS job_id", "concat('t', id) AS title")
    want = Counter(clicks.groupBy("job_id", "date").agg(F.sum("cost").alias("cost")).join(jobs, "job_id").collect())
    path = sinks.scratch_path(spark, "bucketed")
    with_conf = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in with_conf}
    try:
        for k, v in with_conf.items():
            spark.conf.set(k, v)
        bucketed.write_bucketed(clicks, "clicks_b", f"{path}/clicks", "job_id", 8)
        bucketed.write_bucketed(jobs, "jobs_b", f"{path}/jobs", "job_id", 8)
        spark.sql("DROP TABLE clicks_b")  # external: another session finds the folder as it was
        a = bucketed.open_bucketed(spark, "clicks_b2", f"{path}/clicks", clicks.schema, "job_id", 8)
        joined = a.groupBy("job_id", "date").agg(F.sum("cost").alias("cost")).join(spark.table("jobs_b"), "job_id")
        assert Counter(joined.collect()) == want
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert bucketed.buckets_for(0) == 8 and bucketed.buckets_for(10**9) == 512
