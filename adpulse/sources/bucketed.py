"""Tables stored in buckets of a key (S6, J3): jobs and clicks meet by ``job_id`` without a shuffle.

A bucketed table is an external Parquet table at ``path``, one file per bucket, sorted by the
key.  Aggregates and joins on the key (alone or with more columns) over tables with the
same number of buckets then read matching files together.  The session catalog holds
the description only: another session names the same folder with ``open_bucketed``.

Buckets are the unit of work, so their number follows the data: ``buckets_for`` puts about
two million rows into each.  A key's rows lie in one bucket; for keys that may be very heavy use
``operators.skew`` on plain tables instead.  Null keys share a bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

ROWS_PER_BUCKET = 2_000_000


def buckets_for(rows: int, least: int = 8) -> int:
    """A power of two, so that tables of different sizes still have counts that divide each other."""
    n = least
    while n * ROWS_PER_BUCKET < rows:
        n *= 2
    return n


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Store ``df`` as table ``name`` at ``path`` and return it as read from there."""
    # Dealt as the buckets are, so that each is written by one task as one file.
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    return df.sparkSession.table(name)


def open_bucketed(spark: SparkSession, name: str, path: str, schema: StructType, key: str, buckets: int) -> DataFrame:
    """Name a folder that ``write_bucketed`` filled, in a session that does not know it yet.
    ``key`` and ``buckets`` must be those it was written with."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)
