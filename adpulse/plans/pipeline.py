"""The pipeline end to end: ``run_daily`` (raw JSON -> final ads of a day) and
``run_monthly`` (final ads of a month -> jobs, campaigns, clicks, mart).

Layout under ``base`` (Hive-style folders, so dates are prunable columns)::

    final/year=Y/month=M/day=D/      jobs/year=Y/month=M/
    campaigns/year=Y/month=M/        clicks/year=Y/month=M/
    performance/year=Y/month=M/date=.../    quarantine/year=Y/month=M/day=D/
    (final has batch_id folders below the day: -1 from the daily run, others from the stream)

Each step's output is written and read back before the next step uses it, so
lineage is cut at every stored table: a lost executor re-reads stored data
instead of recomputing the month.  Re-running a day or a month replaces exactly
its own folders, with whatever the new result holds.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adpulse.operators.campaigns import campaigns_incremental
from adpulse.operators.clicks import generate_clicks
from adpulse.operators.features import add_features
from adpulse.operators.ingest import flatten_ads, ingest, parse_json
from adpulse.operators.jobs import monthly_jobs
from adpulse.operators.performance import performance_mart
from adpulse.operators.stages import clean_and_locate, finalize
from adpulse.schemas import API_RESULT_SCHEMA, CAMPAIGN_SCHEMA, RAW_SCHEMA
from adpulse.sources import readers, sinks


def _day(day) -> dt.date:
    return dt.date.fromisoformat(day) if isinstance(day, str) else day


def daily_final(raw: DataFrame, places: DataFrame, fill_order: str | None = None,
                max_km: float | None = None) -> DataFrame:
    """Stages 1-4 fused into one plan: raw records -> final ads."""
    return finalize(add_features(clean_and_locate(ingest(raw), places, fill_order, max_km)))


def final_schema(spark: SparkSession) -> StructType:
    """Columns of the final ads, whether or not any are stored."""
    rows = ingest(spark.createDataFrame([], RAW_SCHEMA)).withColumn("created", F.col("created").cast("string"))
    return finalize(add_features(rows)).schema


#: The ``batch_id`` of rows that the daily run wrote.
DAILY = -1


def land_day(docs: DataFrame, path: str, text_col: str = "doc_text") -> None:
    """Landing: nested result documents (JSON text) -> flat raw records as JSON lines."""
    sinks.write_json_lines(flatten_ads(parse_json(docs, text_col, API_RESULT_SCHEMA)), path)


def run_daily(spark: SparkSession, raw_path: str, places: DataFrame, base: str, day,
              persist_stages: bool = False, metrics: dict | None = None, **options) -> DataFrame:
    """Read one day of raw JSON lines, write its final ads, return them (read back).
    Rows that a stream wrote for the same day stay beside them.

    Broken lines go to ``quarantine`` of the same day.  ``persist_stages`` also
    stores stages 1 to 3.  ``metrics`` receives the day's counts, taken while the
    data is written (no extra pass).
    """
    with sinks.scratch(spark):
        return _run_daily(spark, raw_path, places, base, _day(day), persist_stages, metrics, options)


def _run_daily(spark: SparkSession, raw_path: str, places: DataFrame, base: str, d: dt.date, persist_stages: bool,
               metrics: dict | None, options: dict) -> DataFrame:
    scope = {"year": d.year, "month": d.month, "day": d.day}
    good, broken = readers.read_raw_json_quarantine(spark, raw_path)
    seen = {name: Observation(f"{name}-{d}") for name in ("read", "broken", "final")}
    broken = broken.observe(seen["broken"], F.count(F.lit(1)).alias("rows"))
    sinks.replace_scope(broken, f"{base}/quarantine", scope)
    good = good.observe(seen["read"], F.count(F.lit(1)).alias("rows"))

    def stage(n: int, df: DataFrame) -> DataFrame:
        if not persist_stages:
            return df
        sinks.replace_scope(df, f"{base}/stage{n}", scope)
        return readers.read_day(spark, f"{base}/stage{n}", d, df.schema).drop(*scope)
    rows = stage(1, ingest(good))
    rows = stage(2, clean_and_locate(rows, places, options.get("fill_order"), options.get("max_km")))
    final = finalize(stage(3, add_features(rows)))
    counted = final.observe(seen["final"], F.count(F.lit(1)).alias("rows"), *(
        F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ("company_name", "city", "created")))
    # Only the daily run's own folder: what streams wrote for the same day stays.
    own = scope | {"batch_id": DAILY}
    sinks.replace_scope(counted, f"{base}/final", own)
    if metrics is not None:
        found = {name: o.get for name, o in seen.items()}
        metrics.update({"rows_read": found["read"]["rows"], "rows_broken": found["broken"]["rows"],
                        "rows_final": found["final"]["rows"],
                        "duplicates_or_dropped": found["read"]["rows"] - found["final"]["rows"],
                        **{k: v for k, v in found["final"].items() if k != "rows"}})
    return readers.read_scope(spark, f"{base}/final", own, final.schema).drop("batch_id")


def run_monthly(spark: SparkSession, base: str, year: int, month: int,
                match_state: bool = False) -> dict[str, DataFrame]:
    """Jobs, campaigns (incremental), clicks and the performance mart of a month.

    Raises ``ValueError`` when the month has no final ads: nothing is written
    then, and the tables of an earlier run stay.
    """
    with sinks.scratch(spark):
        return _run_monthly(spark, base, year, month, match_state)


def _run_monthly(spark: SparkSession, base: str, year: int, month: int, match_state: bool) -> dict[str, DataFrame]:
    ym = {"year": year, "month": month}
    final = (readers.read_month(spark, f"{base}/final", year, month, final_schema(spark))
             .drop("year", "month", "day", "batch_id"))
    if final.isEmpty():
        raise ValueError(f"no final ads for {year}-{month:02}")

    def stored(name: str, df: DataFrame, *folders: str) -> DataFrame:
        sinks.replace_scope(df, f"{base}/{name}", ym, list(folders))
        return readers.read_month(spark, f"{base}/{name}", year, month, df.schema).drop(*ym)
    jobs = stored("jobs", monthly_jobs(final))

    # campaigns of this month are read and rewritten by the same job: swap
    camp_path = sinks.scope_path(f"{base}/campaigns", ym)
    old = readers.read_if_exists(spark, camp_path, CAMPAIGN_SCHEMA)
    sinks.write_swap(campaigns_incremental(old, final), camp_path)
    campaigns = spark.read.schema(CAMPAIGN_SCHEMA).parquet(camp_path)

    clicks = stored("clicks", generate_clicks(jobs))
    mart = stored("performance", performance_mart(campaigns, jobs, clicks, match_state=match_state,
                                                  materialize=True), "date")
    return {"jobs": jobs, "campaigns": campaigns, "clicks": clicks, "performance": mart}
