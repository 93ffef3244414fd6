from pyspark.sql import functions as F

from adpulse import fixtures as fx
from adpulse.operators.performance import MART_COLUMNS
from adpulse.plans.pipeline import run_daily, run_monthly
from adpulse.sources import readers, sinks
from adpulse.streaming.incremental_ingest import start_incremental_ingest

from conftest import SF_SMALL


def _land_raw(spark, root, day_folder, lo, hi):
    raw = fx.events_as_raw(spark, SF_SMALL).filter((F.col("id").cast("int") >= lo) & (F.col("id").cast("int") < hi))
    sinks.write_json_lines(raw, f"{root}/{day_folder}")


def test_daily_and_monthly_runs(spark):
    base = sinks.scratch_path(spark, "pipeline-test")
    raw = f"{base}/raw"
    places = fx.supplier_places(spark, SF_SMALL)
    _land_raw(spark, raw, "2025/08/01", 0, 600)
    _land_raw(spark, raw, "2025/08/02", 400, 1000)
    d1 = run_daily(spark, f"{raw}/2025/08/01", places, base, "2025-08-01")
    d2 = run_daily(spark, f"{raw}/2025/08/02", places, base, "2025-08-02")
    assert d1.count() > 0 and d2.count() > 0
    assert "bid" in d1.columns and "has_bonus_or_benefit" in d1.columns
    out = run_monthly(spark, base, 2025, 8)
    jobs = out["jobs"]
    assert jobs.count() == jobs.select("job_id").distinct().count()
    # ids 400..599 landed on both days: one job each
    assert jobs.filter(F.col("job_id").cast("int").between(400, 599)).count() <= 200
    camps = out["campaigns"]
    assert camps.count() == camps.select("company_name", "state").distinct().count()
    assert set(MART_COLUMNS) <= set(out["performance"].columns)
    n_mart = out["performance"].count()
    assert n_mart > 0
    # files of a swapped table are replaced: keep the values, not the frame
    first_campaigns = sorted(camps.collect())
    # a second monthly run keeps campaign ids and replaces, not appends
    again = run_monthly(spark, base, 2025, 8)
    assert sorted(again["campaigns"].collect()) == first_campaigns
    assert again["performance"].count() == n_mart


def test_incremental_ingest_only_reads_new_files(spark):
    base = sinks.scratch_path(spark, "stream-test")
    raw = f"{base}/raw"
    places = fx.supplier_places(spark, SF_SMALL)
    ckpt = f"{base}/_checkpoint"
    _land_raw(spark, raw, "2025/08/01", 0, 300)
    start_incremental_ingest(spark, raw, places, base, checkpoint=ckpt).awaitTermination()
    first = spark.read.parquet(f"{base}/final")
    n1 = first.count()
    assert n1 > 0 and {r.day for r in first.select("day").distinct().collect()} == {1}
    _land_raw(spark, raw, "2025/08/02", 300, 600)
    start_incremental_ingest(spark, raw, places, base, checkpoint=ckpt).awaitTermination()
    second = spark.read.parquet(f"{base}/final")
    assert {r.day for r in second.select("day").distinct().collect()} == {1, 2}
    assert second.filter(F.col("day") == 1).count() == n1


def test_io_helpers(spark):
    base = sinks.scratch_path(spark, "io-test")
    from adpulse.schemas import CAMPAIGN_SCHEMA
    assert readers.read_if_exists(spark, f"{base}/missing", CAMPAIGN_SCHEMA).count() == 0
    lines = ['{"id": "1", "latitude": "1.5"}', '{"id": "2", broken']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{base}/raw")
    good, bad = readers.read_raw_json_quarantine(spark, f"{base}/raw")
    assert [r.id for r in good.collect()] == ["1"] and len(bad.collect()) == 1
    df = spark.createDataFrame([(1,), (2,)], "x int")
    sinks.write_overwrite(df, f"{base}/t")
    cur = spark.read.parquet(f"{base}/t")
    sinks.write_swap(cur.withColumn("x", F.col("x") * 10), f"{base}/t")
    assert sorted(r.x for r in spark.read.parquet(f"{base}/t").collect()) == [10, 20]


def test_monthly_run_over_streamed_final(spark):
    base = sinks.scratch_path(spark, "stream-monthly")
    raw = f"{base}/raw"
    places = fx.supplier_places(spark, SF_SMALL)
    _land_raw(spark, raw, "2025/08/01", 0, 500)
    start_incremental_ingest(spark, raw, places, base, checkpoint=f"{base}/_ck").awaitTermination()
    out = run_monthly(spark, base, 2025, 8)
    assert "batch_id" not in out["jobs"].columns
    assert out["jobs"].count() == out["jobs"].select("job_id").distinct().count() > 0


def test_daily_run_with_nearest_places_and_real_fill(spark):
    base = sinks.scratch_path(spark, "pipeline-nearest")
    raw = f"{base}/raw"
    _land_raw(spark, raw, "2025/08/03", 0, 400)
    places = fx.supplier_places(spark, SF_SMALL)
    out = run_daily(spark, f"{raw}/2025/08/03", places, base, "2025-08-03",
                    max_km=500.0, fill_order="salary_min")
    assert out.count() > 0
    # the landing day is a partition of the final table, one row per id
    assert out.select("id").distinct().count() == out.count()
    assert out.filter(F.col("created").isNull()).count() <= out.count()
