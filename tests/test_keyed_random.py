from pyspark.sql import functions as F

from adpulse.functions.keyed_random import Draws
from adpulse.operators.synthetic import add_bid


def _draws(df):
    d = Draws("t", ["id"], uniforms=2, normals=1)
    return d.detach(d.attach(df).select("id", d.uniform(0).alias("u0"), d.uniform(1).alias("u1"),
                                        d.normal(0).alias("z"), *d.seed_cols))


def test_repartition_does_not_change_draws(spark):
    base = spark.range(2000)
    a = {r.id: (r.u0, r.u1, r.z) for r in _draws(base).collect()}
    b = {r.id: (r.u0, r.u1, r.z) for r in _draws(base.repartition(7, "id")).collect()}
    assert a == b


def test_uniform_and_normal_moments(spark):
    df = _draws(spark.range(40000))
    m = df.agg(F.avg("u0"), F.stddev("u0"), F.avg("z"), F.stddev("z"), F.min("u0"), F.max("u0"),
               F.corr("u0", "u1")).first()
    assert abs(m[0] - 0.5) < 0.01 and abs(m[1] - (1 / 12) ** 0.5) < 0.01
    assert abs(m[2]) < 0.02 and abs(m[3] - 1.0) < 0.02
    assert 0 < m[4] and m[5] < 1
    assert abs(m[6]) < 0.02


def test_bid_is_quarter_step_in_range(spark):
    df = add_bid(spark.range(20000).withColumn("id", F.col("id").cast("string")), key="id")
    m = df.agg(F.min("bid"), F.max("bid"), F.avg("bid"),
               F.sum(F.when(F.col("bid") * 4 != F.floor(F.col("bid") * 4), 1).otherwise(0))).first()
    assert m[0] >= 0.25 and m[1] <= 6.25 and m[3] == 0
    # ceil to 0.25 lifts the mean of N(3.25, 1) by about half a step
    assert 3.25 < m[2] < 3.5
