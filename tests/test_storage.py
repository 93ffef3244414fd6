"""Swaps that stop half way, scoped replacement, streams beside daily runs, and the run around them."""

import uuid

import pytest
from pyspark.sql import functions as F

from adpulse import fixtures as fx
from adpulse import session
from adpulse.plans.pipeline import land_day, run_daily, run_monthly
from adpulse.schemas import CAMPAIGN_SCHEMA
from adpulse.sources import readers, sinks
from adpulse.streaming.incremental_ingest import start_incremental_ingest

from conftest import SF_SMALL


class Crash(Exception):
    pass


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _table(spark, n):
    return spark.range(n).select((F.col("id") + 1001).alias("campaign_id"), F.lit("c").alias("company_name"),
                                 F.col("id").cast("string").alias("state"), F.lit(1).alias("cpa_target"),
                                 F.lit(2).alias("budget"), F.lit(0.3).alias("margin"))


class _CrashingFs:
    """A file system that stops at its n-th change."""

    def __init__(self, fs, left):
        self.fs, self.left = fs, left

    def __getattr__(self, name):
        method = getattr(self.fs, name)
        if name not in ("rename", "delete", "mkdirs"):
            return method

        def step(*args):
            if self.left[0] == 0:
                raise Crash(name)
            self.left[0] -= 1
            return method(*args)
        return step


@pytest.mark.parametrize("steps", range(5))
def test_a_swap_that_stops_leaves_the_old_or_the_new_table(spark, monkeypatch, steps):
    base = sinks.scratch_path(spark, "crash")
    path = f"{base}/campaigns/year=2025/month=8"
    sinks.write_swap(_table(spark, 3), path)
    old, new = _rows(_table(spark, 3)), _rows(_table(spark, 5))
    plain = sinks._fs
    left = [steps]
    with monkeypatch.context() as m:
        m.setattr(sinks, "_fs", lambda s, p: (_CrashingFs(plain(s, p)[0], left), plain(s, p)[1]))
        try:
            sinks.write_swap(_table(spark, 5), path)
        except Crash:
            pass
    # whatever was left beside the table is not part of it
    seen = spark.read.parquet(f"{base}/campaigns") if sinks.path_exists(spark, path) else None
    assert seen is None or _rows(seen.select(CAMPAIGN_SCHEMA.fieldNames())) in (old, new)
    got = _rows(readers.read_if_exists(spark, path, CAMPAIGN_SCHEMA))
    assert got in (old, new)
    assert _rows(readers.read_month(spark, f"{base}/campaigns", 2025, 8, CAMPAIGN_SCHEMA)
                 .select(CAMPAIGN_SCHEMA.fieldNames())) == got
    sinks.write_swap(_table(spark, 7), path)
    assert readers.read_if_exists(spark, path, CAMPAIGN_SCHEMA).count() == 7


def test_a_smaller_or_empty_rerun_leaves_nothing_behind(spark):
    base = sinks.scratch_path(spark, "scope")
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "day int, x string")
    month, other = {"year": 2025, "month": 8}, {"year": 2025, "month": 9}
    sinks.replace_scope(df, base, month, ["day"])
    sinks.replace_scope(df, base, other, ["day"])
    sinks.replace_scope(df.filter("day = 1"), base, month, ["day"])
    assert readers.read_month(spark, base, 2025, 8, df.schema).filter("day = 2").count() == 0
    assert spark.read.parquet(base).count() == 5
    sinks.replace_scope(df.filter("day = 9"), base, month, ["day"])
    assert readers.read_month(spark, base, 2025, 8, df.schema).count() == 0
    assert spark.read.parquet(base).filter("month = 9").count() == 3
    assert readers.read_month(spark, base, 2030, 1, df.schema).count() == 0


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def _documents(spark, n):
    """Nested documents with coordinates and a created time, as JSON text."""
    return spark.range(n).select(F.to_json(F.struct(
        F.col("id").cast("string").alias("id"), F.lit("T").alias("title"),
        F.lit("2025-08-01T10:00:00Z").alias("created"),
        F.struct(F.concat(F.lit("co"), (F.col("id") % 5).cast("string")).alias("display_name")).alias("company"),
        F.struct(F.lit("L").alias("display_name"),
                 F.array(F.lit("US"), F.lit("CA"), F.lit("A"), F.lit("B")).alias("area")).alias("location"),
        F.lit(34.5).alias("latitude"), F.lit(-118.0).alias("longitude"))).alias("doc_text"))


def test_from_nested_documents_to_the_mart(spark):
    base = sinks.scratch_path(spark, "end-to-end")
    land_day(_documents(spark, 40), f"{base}/raw/2025/08/01")
    spark.createDataFrame([('{"id": "broken',)], "value string").write.mode("append").text(f"{base}/raw/2025/08/01")
    metrics = {}
    places = fx.supplier_places(spark, SF_SMALL)
    day = run_daily(spark, f"{base}/raw/2025/08/01", places, base, "2025-08-01", persist_stages=True, metrics=metrics)
    assert day.count() == 40 and "batch_id" not in day.columns
    assert metrics["rows_read"] == metrics["rows_final"] == 40 and metrics["rows_broken"] == 1
    assert metrics["null_company_name"] == 0 and metrics["duplicates_or_dropped"] == 0
    assert spark.read.parquet(f"{base}/quarantine").count() == 1
    assert all(spark.read.parquet(f"{base}/stage{n}").count() == 40 for n in (1, 2, 3))
    out = run_monthly(spark, base, 2025, 8)
    assert out["campaigns"].count() == 5 and out["performance"].count() > 0
    # an empty day run later takes the day's ads away, and the month then has nothing to write
    spark.createDataFrame([], "value string").write.mode("overwrite").text(f"{base}/none")
    run_daily(spark, f"{base}/none", places, base, "2025-08-01")
    with pytest.raises(ValueError, match="no final ads"):
        run_monthly(spark, base, 2025, 8)
    with pytest.raises(ValueError, match="no final ads"):
        run_monthly(spark, base, 2031, 1)
    assert spark.read.parquet(f"{base}/campaigns").count() == 5


def test_stream_restarts_and_daily_runs_share_a_table(spark):
    base = sinks.scratch_path(spark, f"shared-{uuid.uuid4().hex[:6]}")
    places = fx.supplier_places(spark, SF_SMALL)

    def land(day, lo, hi):
        raw = fx.events_as_raw(spark, SF_SMALL).filter(F.col("id").cast("int").between(lo, hi - 1))
        sinks.write_json_lines(raw.repartition(3), f"{base}/raw/2025/08/{day:02}")
    land(1, 0, 300)
    start_incremental_ingest(spark, f"{base}/raw", places, base, max_files=1).awaitTermination()
    first = spark.read.parquet(f"{base}/final")
    n = first.count()
    assert n == first.select("id").distinct().count() > 0
    start_incremental_ingest(spark, f"{base}/raw", places, base, max_files=1).awaitTermination()
    assert spark.read.parquet(f"{base}/final").count() == n
    land(2, 300, 500)
    run_daily(spark, f"{base}/raw/2025/08/02", places, base, "2025-08-02")
    both = spark.read.parquet(f"{base}/final")
    assert {r.day for r in both.select("day").distinct().collect()} == {1, 2}
    assert both.filter("day = 1").count() == n and both.count() == both.select("id").distinct().count()


def _land(spark, path, lo, hi):
    raw = fx.events_as_raw(spark, SF_SMALL).filter(F.col("id").cast("int").between(lo, hi - 1))
    sinks.write_json_lines(raw.repartition(3), path)


def test_daily_run_keeps_what_a_stream_wrote_that_day(spark):
    base = sinks.scratch_path(spark, f"same-day-{uuid.uuid4().hex[:6]}")
    places = fx.supplier_places(spark, SF_SMALL)
    _land(spark, f"{base}/raw/2025/08/01", 0, 300)
    start_incremental_ingest(spark, f"{base}/raw", places, base).awaitTermination()
    streamed = set(r.id for r in spark.read.parquet(f"{base}/final").collect())
    _land(spark, f"{base}/other", 300, 500)
    day = run_daily(spark, f"{base}/other", places, base, "2025-08-01")
    own = set(r.id for r in day.collect())
    assert streamed and own and not streamed & own
    both = [r.id for r in readers.read_day(spark, f"{base}/final", "2025-08-01").collect()]
    assert sorted(both) == sorted(streamed | own)
    # Run again with fewer rows: only its own rows are replaced.
    _land(spark, f"{base}/less", 300, 320)
    less = set(r.id for r in run_daily(spark, f"{base}/less", places, base, "2025-08-01").collect())
    both = [r.id for r in readers.read_month(spark, f"{base}/final", 2025, 8).collect()]
    assert less < own and sorted(both) == sorted(streamed | less)


def test_stream_keeps_an_id_once_over_batches_restarts_and_daily_runs(spark):
    base = sinks.scratch_path(spark, f"ids-{uuid.uuid4().hex[:6]}")
    places = fx.supplier_places(spark, SF_SMALL)
    run = lambda **more: start_incremental_ingest(spark, f"{base}/raw", places, base, **more).awaitTermination()
    ids = lambda: [r.id for r in spark.read.parquet(f"{base}/final").collect()]
    _land(spark, f"{base}/raw/2025/08/01", 0, 200)
    run(max_files=1)
    first = ids()
    _land(spark, f"{base}/raw/2025/08/02", 100, 300)
    run(max_files=2)
    second = ids()
    assert len(second) == len(set(second)) > len(first) and set(first) < set(second)
    # An ad keeps the day on which it landed first.
    assert spark.read.parquet(f"{base}/final").filter("day = 1").count() == len(first)
    # What a daily run took is not taken by the stream again.
    _land(spark, f"{base}/raw/2025/08/03", 300, 400)
    run_daily(spark, f"{base}/raw/2025/08/03", places, base, "2025-08-03")
    n = len(ids())
    run()
    assert len(ids()) == n == len(set(ids()))
    # Beyond the horizon an ad is new again.
    _land(spark, f"{base}/raw/2026/08/01", 0, 50)
    run(horizon_days=30)
    assert len(ids()) > n


def test_stream_quarantines_broken_lines_and_files_without_a_day(spark):
    base = sinks.scratch_path(spark, f"broken-{uuid.uuid4().hex[:6]}")
    places = fx.supplier_places(spark, SF_SMALL)
    _land(spark, f"{base}/raw/2025/08/01", 0, 100)
    _land(spark, f"{base}/raw/elsewhere", 100, 130)
    spark.createDataFrame([('{"id": "broken',), ("not json",)], "value string").write.mode("append").text(f"{base}/raw/2025/08/01")
    start_incremental_ingest(spark, f"{base}/raw", places, base).awaitTermination()
    bad = spark.read.parquet(f"{base}/quarantine").groupBy("reason", "day").count().collect()
    n = {name: [len(df.collect()) for df in readers.read_raw_json_quarantine(spark, f"{base}/raw/{name}")]
         for name in ("2025/08/01", "elsewhere")}
    # As the daily run quarantines them.
    assert {(r.reason, r.day): r["count"] for r in bad} == {
        ("broken line", 1): n["2025/08/01"][1], ("broken line", 0): n["elsewhere"][1], ("no landing day", 0): n["elsewhere"][0]}
    assert n["2025/08/01"][1] > 2
    assert spark.read.parquet(f"{base}/final").select("day").distinct().collect()[0].day == 1


def test_runs_delete_only_their_own_scratch_tables(spark):
    base = sinks.scratch_path(spark, f"scratch-{uuid.uuid4().hex[:6]}")
    other = sinks.materialize(spark.range(7), "other")
    _land(spark, f"{base}/raw", 0, 50)
    run_daily(spark, f"{base}/raw", fx.supplier_places(spark, SF_SMALL), base, "2025-08-01")
    assert other.count() == 7
    with sinks.scratch(spark) as outer:
        kept = sinks.materialize(spark.range(3), "kept")
        with sinks.scratch(spark) as inner:
            sinks.materialize(spark.range(2), "gone")
            gone = inner[0]
        assert not sinks.path_exists(spark, gone) and kept.count() == 3 and len(outer) == 1
    assert not sinks.path_exists(spark, outer[0])
