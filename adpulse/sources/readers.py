"""Readers S1-S5, S10."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from adpulse.schemas import RAW_SCHEMA, SEARCH_SCHEMA
from adpulse.sources.sinks import path_exists, recover, recover_below, scope_path

CORRUPT = "_corrupt_record"


def read_raw_json(spark: SparkSession, path: str, schema: StructType = RAW_SCHEMA) -> DataFrame:
    """JSON lines with a fixed schema (unknown fields dropped, missing ->
    null, field parse errors -> null; a broken line gives an all-null row)."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def read_raw_json_quarantine(spark: SparkSession, path: str,
                             schema: StructType = RAW_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """S1 with broken lines routed aside: (good rows, broken rows with their
    raw text in ``_corrupt_record``).  Spark refuses queries that read only
    the corrupt-record column of a raw file, so broken rows keep all fields."""
    full = StructType(list(schema.fields) + [StructField(CORRUPT, StringType())])
    df = (spark.read.schema(full).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT).json(path))
    good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = df.filter(F.col(CORRUPT).isNotNull())
    return good, bad


def _ymd(day: dt.date | str):
    d = dt.date.fromisoformat(day) if isinstance(day, str) else day
    return d.year, d.month, d.day


def read_scope(spark: SparkSession, base: str, scope: dict, schema: StructType | None = None) -> DataFrame:
    """One scope of a table with ``key=value`` folders: only that folder is
    listed, whatever the table's age.  With a ``schema`` a missing or empty
    scope gives no rows."""
    path = scope_path(base, scope)
    recover(spark, path)
    recover_below(spark, path)
    if schema is not None and not path_exists(spark, path):
        return spark.createDataFrame([], schema).withColumns({k: F.lit(v) for k, v in scope.items()})
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if schema is not None:
        # the scope's own values are constants, the folders below are read
        return reader.parquet(path).withColumns({k: F.lit(v) for k, v in scope.items()})
    return reader.option("basePath", base).parquet(path)


def read_day(spark: SparkSession, base: str, day, schema: StructType | None = None) -> DataFrame:
    """One day of a dataset partitioned by year/month/day."""
    y, m, d = _ymd(day)
    return read_scope(spark, base, {"year": y, "month": m, "day": d}, schema)


def read_month(spark: SparkSession, base: str, year: int, month: int,
               schema: StructType | None = None) -> DataFrame:
    """S3: every day of one month."""
    return read_scope(spark, base, {"year": year, "month": month}, schema)


def read_if_exists(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at ``path``, or an empty one with ``schema`` when there is
    none.  A swap that was cut short is completed first, so a table that
    exists is never taken for missing.  Other read errors propagate."""
    recover(spark, path)
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def read_search_csv(spark: SparkSession, path: str) -> DataFrame:
    """Search list CSV; the space after each comma is dropped."""
    return (spark.read.schema(SEARCH_SCHEMA).option("header", True)
            .option("ignoreLeadingWhiteSpace", True).csv(path))


def register_views(spark: SparkSession, base: str, year: int, month: int,
                   tables=("jobs", "campaigns", "clicks", "performance")) -> list[str]:
    """Temp views over one month of the stored tables (for SQL users)."""
    for name in tables:
        read_month(spark, f"{base}/{name}", year, month).drop("year", "month") \
            .createOrReplaceTempView(name)
    return list(tables)
