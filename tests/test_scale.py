"""Results that must not depend on sizes, outliers, distances or how a key is spelled."""

import math
import re

import pytest
from pyspark.sql import functions as F

from adpulse.functions.keyed_random import Draws
from adpulse.operators import campaigns, clean, geo
from adpulse.operators.numbering import global_rank


@pytest.mark.parametrize("parts", [3, 8])
def test_ranks_of_many_keys_are_distinct_and_contiguous(spark, parts):
    n = 1_000_000
    df = spark.range(n).select(F.md5(F.col("id").cast("string")).alias("k"), F.lit("payload").alias("p"), "id")
    r = global_rank(df, ["k"], num_partitions=parts).agg(
        F.count_distinct("rank").alias("d"), F.min("rank").alias("lo"), F.max("rank").alias("hi")).first()
    assert (r.d, r.lo, r.hi) == (n, 1, n)


def test_campaign_ids_of_many_keys(spark):
    ads = spark.range(300_000).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("company_name"),
                                      F.lit("s").alias("state"), F.lit(2.0).alias("bid"))
    r = campaigns.campaigns_incremental(None, ads).agg(
        F.count_distinct("campaign_id").alias("d"), F.min("campaign_id").alias("lo"), F.max("campaign_id").alias("hi")).first()
    assert (r.d, r.lo, r.hi) == (300_000, 1001, 301_000)


def test_one_outlier_does_not_gather_the_rows(spark):
    df = spark.range(50_000).select(F.when(F.col("id") == 7, 1 << 60).otherwise(F.col("id")).alias("t"),
                                    F.when(F.col("id") % 3 == 0, F.col("id")).alias("v"))
    out = clean.forward_fill(df, "v", "t", n_blocks=8)
    got = {r.t: r.v for r in out.collect()}
    assert got[1 << 60] == 49_998 and all(got[t] == t - t % 3 for t in range(50_000) if t != 7)
    sizes = [r["count"] for r in clean.materialize(
        df.repartitionByRange(8, "t").withColumn("b", F.spark_partition_id())).groupBy("b").count().collect()]
    assert max(sizes) < 3 * 50_000 / 8


def test_ties_are_filled_alike_whatever_the_partitions(spark):
    df = spark.createDataFrame([(1, 5), (1, None), (1, 3), (2, None), (2, 9), (3, None)], "t int, v int")
    want = None
    for n in (1, 2, 5):
        got = sorted(map(str, clean.forward_fill(df.repartition(n), "v", "t", n_blocks=n).collect()))
        want = want or got
        assert got == want


def test_nearest_place_has_no_distance_limit(spark):
    places = spark.createDataFrame([(0.0, 0.0, "a"), (100.0, 50.0, "b"), (179.9, -60.0, "c")],
                                   "longitude double, latitude double, city string").withColumns(
        {c: F.lit(None).cast("string") for c in ("town", "road", "county", "state", "country")})
    points = spark.createDataFrame([(1, 0.001, 0.0), (2, 90.0, 40.0), (3, -170.0, -80.0), (4, -90.0, 0.0), (5, None, 1.0)],
                                   "point_id int, longitude double, latitude double")
    got = {r.point_id: r.city for r in geo.reverse_geocode(points, places).collect()}
    assert got == {1: "a", 2: "b", 3: "c", 4: "a", 5: None}
    near = {r.point_id: r.city for r in geo.reverse_geocode(points, places, max_km=10.0).collect()}
    assert near == {1: "a", 2: None, 3: None, 4: None, 5: None}


def test_a_dense_city_is_searched_in_small_cells(spark):
    places = spark.range(3000).select((-118 + F.col("id") % 60 * 0.01).alias("longitude"),
                                      (34 + F.col("id") / 60 * 0.01).alias("latitude"),
                                      F.col("id").cast("string").alias("city")).withColumns(
        {c: F.lit(None).cast("string") for c in ("town", "road", "county", "state", "country")})
    points = spark.range(20_000).select("id", (-118 + F.rand(1) * 0.6).alias("longitude"),
                                        (34 + F.rand(2) * 0.5).alias("latitude"))
    assert geo.nearest_places(points, places).count() == 20_000


def _numbers(df, node):
    """Output rows of the executed plan's nodes of a kind."""
    out, left = [], [df._jdf.queryExecution().executedPlan()]
    while left:
        plan = left.pop()
        name = plan.getClass().getSimpleName()
        if name.startswith("AdaptiveSparkPlan"):
            left.append(plan.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            left.append(plan.plan())
            continue
        if re.search(node, name) and plan.metrics().contains("numOutputRows"):
            out.append(plan.metrics().apply("numOutputRows").value())
        left += [plan.children().apply(i) for i in range(plan.children().size())]
    return out


def test_far_coordinates_do_not_meet_all_places(spark):
    """100,000 coordinates in an ocean, 5000 km and more from 20,000 places: no join comes near all pairs."""
    places = spark.range(20_000).select((-5 + F.rand(3) * 15).alias("longitude"), (40 + F.rand(4) * 15).alias("latitude"),
                                        F.col("id").cast("string").alias("city")).withColumns(
        {c: F.lit(None).cast("string") for c in ("town", "road", "county", "state", "country")})
    points = spark.range(100_000).select("id", (-150 + F.rand(1) * 40).alias("longitude"), (-30 + F.rand(2) * 50).alias("latitude"))
    got = geo.nearest_places(points, places)
    rows = got.collect()
    assert len(rows) == 100_000 and min(r.distance_km for r in rows) > 5000
    assert max(_numbers(got, "Join|Generate")) < 140 * 100_000  # the top cells; all pairs would be 2000 million
    some = rows[::5000]
    all_places = [(r.longitude, r.latitude) for r in places.collect()]
    for r in some:
        want = min(_km(r.longitude, r.latitude, lo, la) for lo, la in all_places)
        assert abs(r.distance_km - want) < 1e-6


def _km(lo1, la1, lo2, la2):
    p, q = math.radians(la1), math.radians(la2)
    a = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(lo2 - lo1) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(1.0, a)))


def test_keys_that_read_alike_draw_apart(spark):
    rows = [("A", None), (None, "A"), ("a|b", "c"), ("a", "b|c"), ("", None), (None, None), ("n", None), ("1:n", None)]
    df = spark.createDataFrame(rows, "x string, y string")
    d = Draws("t", ["x", "y"], uniforms=1)
    assert len({(r[2], r[3]) for r in d.attach(df).collect()}) == len(rows)


def test_normals_follow_the_normal_law(spark):
    d = Draws("ks", ["id"], normals=2)
    df = d.attach(spark.range(20_000))
    z = sorted(r.z for r in df.select(d.normal(0).alias("z")).collect())
    cdf = [0.5 * (1 + math.erf(v / math.sqrt(2))) for v in z]
    n = len(z)
    ks = max(max(abs(c - i / n), abs(c - (i + 1) / n)) for i, c in enumerate(cdf))
    assert ks < 1.63 / math.sqrt(n)  # 1 % level
    kurtosis = sum(v ** 4 for v in z) / n - 3 * (sum(v ** 2 for v in z) / n) ** 2
    assert abs(kurtosis) < 0.25
    assert abs(df.select(F.corr(d.normal(0), d.normal(1))).first()[0]) < 0.03


def test_uniforms_are_even(spark):
    d = Draws("chi", ["id"], uniforms=2)
    counts = (d.attach(spark.range(40_000)).groupBy(F.floor(d.uniform(1) * 40).alias("b")).count().collect())
    chi = sum((r["count"] - 1000) ** 2 / 1000 for r in counts)
    assert len(counts) == 40 and chi < 72.1  # 0.1 % level, 39 degrees of freedom
