"""Ranks inside groups without a window over a whole group.

Rows are range-partitioned on group and order and stored with their partition's
number, so every later plan reads one fixed assignment.  A window numbers the
rows of one (partition, group); prefix sums over the counts, a table of one row
per partition and group, give each such part its first rank.  A group that
holds most rows spreads over as many partitions as its share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adpulse.llm.common import parts_for, stored

#: Rows of a partition.
PER_PARTITION = 100_000


def ranked(df: DataFrame, group: str, order: Sequence[Column], rows: int | None = None) -> DataFrame:
    """``df`` with ``rank`` (from 0) and ``size`` (rows) inside each ``group`` (not null).
    Rows that ``order`` does not tell apart must be equal or interchangeable.
    ``rows`` is the number of rows, if known."""
    n = parts_for(df.count() if rows is None else rows, PER_PARTITION)
    dealt = stored(df.repartitionByRange(n, F.col(group), *order).withColumn("__part", F.spark_partition_id()), "ranged")
    counts = dealt.groupBy("__part", group).agg(F.count(F.lit(1)).alias("__n"))
    own = Window.partitionBy(group)
    first = counts.select(F.col("__part").alias("__p"), F.col(group).alias("__g"),
                          (F.sum("__n").over(own.orderBy("__part")) - F.col("__n")).alias("__first"),
                          F.sum("__n").over(own).alias("size"))
    inside = Window.partitionBy("__part", group).orderBy(*order)
    return (dealt.withColumn("__i", F.row_number().over(inside))
            .join(first, (F.col("__part") == F.col("__p")) & (F.col(group) == F.col("__g")))
            .withColumn("rank", (F.col("__first") + F.col("__i") - 1).cast("long"))
            .drop("__part", "__p", "__g", "__first", "__i"))
