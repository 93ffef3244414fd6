"""Stream queries: the incremental ingest over several landings (A7 and C1 across batches)."""

from __future__ import annotations

from pyspark.sql import functions as F

from adpulse import fixtures as fx
from adpulse.plans.catalog import register
from adpulse.schemas import RAW_SCHEMA
from adpulse.sources import sinks
from adpulse.streaming.incremental_ingest import start_incremental_ingest


@register("stream_dedup", """
SELECT CAST(event_id AS VARCHAR) AS id, min(CAST(day AS INTEGER)) AS day
FROM (SELECT event_id, 1 AS day FROM events WHERE event_id % 3 = 0
      UNION ALL SELECT event_id, 2 FROM events WHERE event_id % 2 = 0
      UNION ALL SELECT event_id, 3 FROM events)
GROUP BY event_id""")
def stream_dedup(spark, sf_dir):
    """A7 across micro-batches: three landings whose ids overlap, the stream started
    anew for each; every id is kept once, with the day on which it landed first."""
    base = sinks.scratch_path(spark, "stream-dedup")
    raw = fx.events_as_raw(spark, sf_dir)
    raw = raw.select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields))
    raw = raw.withColumn("latitude", F.coalesce(F.col("latitude").try_cast("double"), F.lit(1.5)).cast("string"))
    number = F.col("id").cast("long")
    for day, landed in enumerate((number % 3 == 0, number % 2 == 0, F.lit(True)), 1):
        sinks.write_json_lines(raw.filter(landed), f"{base}/raw/2025/08/{day:02}")
        start_incremental_ingest(spark, f"{base}/raw", fx.supplier_places(spark, sf_dir), base).awaitTermination()
    return spark.read.parquet(f"{base}/final").select("id", "day")
