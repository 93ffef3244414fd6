"""Cleaning: dedup by id (A7), forward fill (W1), filters and defaults."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adpulse.sources.sinks import materialize


def dedup_latest(df: DataFrame, key: str = "id", order: Sequence[str] = ("created",)) -> DataFrame:
    """One row per ``key``; the survivor is the row with the greatest
    ``order`` values (nulls lowest), ties broken by the remaining columns in
    schema order, so the choice is deterministic.  Null keys form one group.

    ``max(struct(...))`` is an ordinary aggregate: partial maxima are combined
    map-side, so even a key holding a third of all rows never gathers its rows
    in one task.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    packed = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(list(order) + rest)])
    best = df.groupBy(key).agg(F.max(packed).alias("__best"))
    names = list(order) + rest
    return best.select(key, *[F.col("__best")[f"o{i}"].alias(c) for i, c in enumerate(names)]) \
        .select(*df.columns)


def forward_fill(df: DataFrame, col: str, order_col: str, partition_cols: Sequence[str] = (),
                 tie_cols: Sequence[str] = (), n_blocks: int | None = None, out: str | None = None) -> DataFrame:
    """``last(col, ignorenulls)`` over ``partition_cols`` ordered by
    ``order_col`` (UNBOUNDED PRECEDING .. CURRENT ROW), in two levels.

    Rows are range-partitioned on (partition, order, ties) into ``n_blocks``
    blocks (default: the shuffle partitions) and stored with their block's
    number.  The boundaries are quantiles of the rows themselves, so neither a
    partition value holding most rows nor an outlier in the order column puts
    many rows in one block:

    1. fill inside each (partition, block);
    2. per (partition, block) keep the last non-null value - a table with at most
       one row per block and partition value - and carry it forward across
       blocks with a window over that small table;
    3. rows still null after step 1 take the carry of their block.

    Equal order values are ordered by ``tie_cols`` and then by ``col`` itself, on
    both levels, so the result depends on the rows' values alone.  Any type
    with an order will do.  Ordering by the filled column itself is the
    identity (nulls sort first, and a non-null row is its own last non-null
    value), so it returns the input unchanged without planning any window.
    """
    out = out or col
    if order_col == col:
        return df if out == col else df.withColumn(out, F.col(col))
    parts = list(partition_cols)
    n = n_blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_order = [F.col(c).asc_nulls_first() for c in (order_col, *tie_cols, col)]
    x = materialize(df.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in parts], *in_order)
                    .withColumn("__blk", F.spark_partition_id()), "fill-blocks")
    inner = (Window.partitionBy(*parts, "__blk").orderBy(*in_order)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    x = x.withColumn("__local", F.last(col, ignorenulls=True).over(inner))

    place = F.struct(*[F.col(c) for c in (order_col, *tie_cols, col)])
    last_in_block = (x.groupBy(*parts, "__blk")
                     .agg(F.max(F.when(F.col(col).isNotNull(), place))[col].alias("__last")))
    across = (Window.partitionBy(*parts).orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1))
    carry = last_in_block.select(*parts, "__blk", F.last("__last", ignorenulls=True).over(across).alias("__carry"))
    cond = [x[c].eqNullSafe(carry[c]) for c in parts + ["__blk"]]
    joined = x.join(carry, cond, "left").select(x["*"], carry["__carry"])
    return (joined.withColumn(out, F.coalesce(F.col("__local"), F.col("__carry")))
            .drop("__blk", "__local", "__carry"))


def fill_created_reference(df: DataFrame, col: str = "created") -> DataFrame:
    """W1 exactly as the reference orders it: by ``created`` itself.  Nulls
    sort first, so there is never an earlier non-null value: nothing is filled
    and each value stays as it was (``forward_fill`` returns the input)."""
    return forward_fill(df, col, order_col=col)


def drop_missing_coordinates(df: DataFrame) -> DataFrame:
    """Keep rows with both latitude and longitude."""
    return df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def fill_defaults(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Fill nulls in named columns (contract_time -> full_time)."""
    return df.fillna(defaults or {"contract_time": "full_time"})
