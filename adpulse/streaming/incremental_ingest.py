"""Incremental daily ingest with Structured Streaming.

The reference runs stages 1-4 once a day over the folder of raw JSON files
the extraction landed.  The same stages can run incrementally: a file-source
stream picks up only raw files it has not seen (tracked in the checkpoint),
and each micro-batch goes through the batch plan (``daily_final``) and is
appended to the final table, partitioned by the landing day taken from the
file's ``YYYY/MM/DD`` folder.

Run with ``availableNow=True`` it processes everything new and stops - a
restartable replacement for the daily batch.  Output partitions are
(year, month, day, batch_id), so a retried micro-batch overwrites its own
files instead of appending twice.  The checkpoint lies beside the table by
default, so a restart continues where the last run ended.  The daily batch run
writes the same layout (``batch_id=-1``), so both can fill one table.

Duplicates: inside a micro-batch the newest version of an id stays, as in the
batch run.  Across batches the first landed one stays: the ids of every batch
are stored in a key table (``_ids/batch_id=N``, the stream's keyed state), and a
batch drops the ids that earlier batches or daily runs of the last ``horizon_days``
landing days already have.  The batch's own folder is left out, so a batch
that is retried or restarted after a crash decides as it did the first time.
``horizon_days`` bounds what a batch reads; an ad that returns later than that is
left to the monthly dedup (``monthly_jobs``).

Broken lines, and rows of files that lie outside a ``YYYY/MM/DD`` folder, go to
``quarantine`` (``reason``; year, month and day are 0 where unknown) and not to
the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from adpulse.plans.pipeline import DAILY, daily_final
from adpulse.schemas import RAW_SCHEMA
from adpulse.sources import readers, sinks

#: Landing days over which an id is remembered.
HORIZON_DAYS = 62
_IDS = "id string, landed date"
_DAY = ("year", "month", "day")
_DAY_PATTERN = r"/(\d{4})/(\d{2})/(\d{2})/[^/]*$"


def raw_stream(spark: SparkSession, raw_root: str, max_files: int | None = None) -> DataFrame:
    """Raw ad records of every file under ``raw_root/YYYY/MM/DD/`` with the
    landing day as year/month/day columns (null for files elsewhere) and broken
    lines in ``_corrupt_record``."""
    full = StructType([*RAW_SCHEMA.fields, StructField(readers.CORRUPT, StringType())])
    reader = (spark.readStream.schema(full).option("recursiveFileLookup", "true")
              .option("columnNameOfCorruptRecord", readers.CORRUPT))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    df = reader.json(raw_root)
    path = F.col("_metadata.file_path")
    return df.withColumns({
        name: F.regexp_extract(path, _DAY_PATTERN, i).try_cast("int") for i, name in enumerate(_DAY, 1)})


def _landed():
    return F.try_make_date(*_DAY) if hasattr(F, "try_make_date") else F.expr(
        "try_to_date(format_string('%04d-%02d-%02d', year, month, day))")


def _write_batch(df: DataFrame, path: str, batch_id: int, *folders: str) -> None:
    """Partitions of this batch only; a retried batch replaces its own files."""
    (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*folders, "batch_id").parquet(path))


def _seen_ids(spark: SparkSession, base: str, batch_id: int, since) -> DataFrame:
    """Ids of other batches and of daily runs that landed on ``since`` or later."""
    out = spark.createDataFrame([], "id string")
    if sinks.path_exists(spark, f"{base}/_ids"):
        ids = spark.read.schema(_IDS + ", batch_id long").parquet(f"{base}/_ids")
        out = ids.filter((F.col("batch_id") < batch_id) & (F.col("landed") >= since)).select("id")
    if sinks.path_exists(spark, f"{base}/final"):
        final = spark.read.schema("id string, year int, month int, day int, batch_id long").parquet(f"{base}/final")
        daily = final.filter(F.col("batch_id") == DAILY).filter(
            F.col("year") * 10_000 + F.col("month") * 100 + F.col("day") >= int(since.strftime("%Y%m%d")))
        out = out.unionByName(daily.select("id"))
    return out


def start_incremental_ingest(spark: SparkSession, raw_root: str, places: DataFrame, base: str,
                             checkpoint: str | None = None, available_now: bool = True,
                             max_files: int | None = None, horizon_days: int = HORIZON_DAYS, **options):
    """Start the stream; returns the StreamingQuery (call ``awaitTermination``)."""
    checkpoint = checkpoint or f"{base}/_checkpoints/ingest"
    stream = raw_stream(spark, raw_root, max_files)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        with sinks.scratch(batch.sparkSession):
            _per_batch(batch, batch_id)

    def _per_batch(batch: DataFrame, batch_id: int) -> None:
        # Stored once: the file source would be parsed again for each of the outputs.
        rows = sinks.materialize(batch.withColumn("landed", _landed()), "micro-batch")
        reason = F.when(F.col(readers.CORRUPT).isNotNull(), "broken line").when(F.col("landed").isNull(), "no landing day")
        rows = rows.withColumn("reason", reason)
        bad = rows.filter("reason is not null").withColumns({c: F.when(F.col("landed").isNull(), 0).otherwise(F.col(c)) for c in _DAY})
        _write_batch(bad.drop("landed"), f"{base}/quarantine", batch_id, *_DAY)
        good = rows.filter("reason is null").drop("reason", readers.CORRUPT)
        # the landing day rides along through the stages (the surviving
        # version of a duplicated id keeps its own landing day)
        first = good.agg(F.date_sub(F.min("landed"), horizon_days)).first()[0]
        if first is None:
            return
        seen = _seen_ids(batch.sparkSession, base, batch_id, first)
        new = good.join(seen.distinct(), "id", "left_anti").select(good.columns)
        _write_batch(daily_final(new.drop("landed"), places, **options), f"{base}/final", batch_id, *_DAY)
        # After the rows: a crash between the two leaves a batch that is done again as a whole.
        written = batch.sparkSession.read.schema("id string, year int, month int, day int, batch_id long").parquet(f"{base}/final")
        _write_batch(written.filter(F.col("batch_id") == batch_id).select("id", _landed().alias("landed")), f"{base}/_ids", batch_id)

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
