"""Global dense numbering without a single-task window.

``row_number() OVER (ORDER BY k)`` with no partition sends every row to one
task.  Instead:

1. range-partition the rows on the order keys into ``n`` partitions and store
   them with their partition's number in the shared folder, so that everything
   after reads one fixed assignment (two plans that each sample their own
   boundaries would not agree, and a retried task could move rows);
2. number the rows of each partition by a window over (partition);
3. count rows per partition and turn the counts into prefix offsets - a table
   of at most ``n`` rows, broadcast back.

rank = offset(partition) + position.  The result equals the global
``row_number``; rows with equal keys are ordered by their other columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adpulse.sources.sinks import materialize


def _order(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in cols]


def global_rank(df: DataFrame, order_cols: Sequence[str], name: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """Add a 1-based ``name`` column equal to row_number() over the global order."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(df.repartitionByRange(n, *_order(order_cols))
                         .withColumn("__pid", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    # At most n rows: bounded by construction, so broadcasting is safe.
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    rest = [c for c, kind in df.dtypes if c not in order_cols and not kind.startswith("map")]
    inside = Window.partitionBy("__pid").orderBy(*_order([*order_cols, *rest]))
    return (ranged.withColumn("__pos", F.row_number().over(inside))
            .join(F.broadcast(offsets), "__pid")
            .withColumn(name, F.col("__off") + F.col("__pos"))
            .drop("__pid", "__pos", "__off"))


def assign_ids(df: DataFrame, order_cols: Sequence[str], base, name: str = "campaign_id",
               num_partitions: int | None = None) -> DataFrame:
    """Contiguous ids base+1, base+2, ... in ``order_cols`` order (nulls first).

    ``base`` is a Column (e.g. a scalar subquery of the current maximum id) or
    a number.
    """
    base_col = base if isinstance(base, Column) else F.lit(base)
    ranked = global_rank(df, order_cols, "__rank", num_partitions)
    return (ranked.withColumn(name, (F.col("__rank") + base_col.cast("long")).cast("long"))
            .drop("__rank"))
