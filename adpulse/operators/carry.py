"""Running sums (W4) and forward fills (W1) that go on from one scope to the next.

A scope is a day or a month; its name is an ISO date or month, so names sort by
time.  At the end of a scope one row per key is stored: the key's total so far or
its last value that is not null.  The next scope starts from these rows and reads
nothing else of the scopes before, so its cost follows its own rows and the number
of keys, not the age of the table.  Scopes one after the other give what one window
over all of them gives, if every row of a scope comes after all rows of the scopes
before it (the callers' order).

``run_scope`` keeps rows and state of each scope in its own folder.  A scope may be
done again (it starts from the state of the latest scope before it, never its own);
it returns the names of later scopes, whose rows still rest on the old state.

Keys may be null (nulls are one key).  A null value adds nothing to a sum; a key
without any value has no state.  Empty scopes hand on the state as it was.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from adpulse.operators.clean import forward_fill
from adpulse.sources import sinks

#: Of rows and the state before them (None: there is none) the rows' result, or the state after them.
Step = Callable[[DataFrame, DataFrame | None], DataFrame]


def _sum_type(df: DataFrame, value: str) -> str:
    """A type that sums of sums keep, however many scopes there are."""
    kind = df.schema[value].dataType
    if isinstance(kind, DecimalType):
        return f"decimal(38,{kind.scale})"
    return "double" if kind.typeName() in ("double", "float") else "bigint"


def _with_opening(df: DataFrame, opening: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``df`` with the key's opening value as ``__opening`` (null: none)."""
    if not keys:  # one row at most
        return df.withColumn("__opening", opening.agg(F.max(value)).scalar())
    names = [f"__key{i}" for i in range(len(keys))]
    before = opening.select(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True)), F.col(value).alias("__opening"))
    same: list[Column] = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)]
    return df.join(before, same, "left").drop(*names)


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                opening: DataFrame | None = None, out: str = "running") -> DataFrame:
    """The sum of ``value`` over the key's earlier rows, of this scope and of those before it (null: no
    earlier row with a value).  One task holds a key's rows of one scope, so they should be daily sums."""
    kind = _sum_type(df, value)
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn(out, F.sum(value).over(before).cast(kind))
    if opening is None:
        return df
    total = F.col("__opening") + F.coalesce(F.col(out), F.lit(0).cast(kind))
    return (_with_opening(df, opening, keys, "total")
            .withColumn(out, F.when(F.col("__opening").isNull(), F.col(out)).otherwise(total).cast(kind)).drop("__opening"))


def closing_totals(df: DataFrame, keys: Sequence[str], value: str, opening: DataFrame | None = None) -> DataFrame:
    """``keys, total`` after this scope.  Sums combine before the shuffle, so a hot key costs a row per task."""
    kind = _sum_type(df, value)
    parts = df.select(*keys, F.col(value).cast(kind).alias("total"))
    if opening is not None:
        parts = parts.unionByName(opening.select(*keys, "total"))
    return parts.groupBy(*keys).agg(F.sum("total").cast(kind).alias("total")).filter("total is not null")


def fill_on(df: DataFrame, col: str, order_col: str, keys: Sequence[str] = (), tie_cols: Sequence[str] = (),
            opening: DataFrame | None = None, out: str | None = None, n_blocks: int | None = None) -> DataFrame:
    """``forward_fill`` of this scope; rows before the key's first value take the one of the scopes before."""
    out = out or col
    filled = forward_fill(df, col, order_col, keys, tie_cols, n_blocks, out)
    if opening is None:
        return filled
    return (_with_opening(filled, opening, keys, "value")
            .withColumn(out, F.coalesce(F.col(out), F.col("__opening"))).drop("__opening"))


def closing_values(df: DataFrame, col: str, order_col: str, keys: Sequence[str] = (), tie_cols: Sequence[str] = (),
                   opening: DataFrame | None = None) -> DataFrame:
    """``keys, value``: the last value that is not null up to the end of this scope."""
    place = F.struct(*(F.col(c).alias(f"o{i}") for i, c in enumerate((order_col, *tie_cols))), F.col(col).alias("value"))
    last = (df.filter(F.col(col).isNotNull()).groupBy(*keys).agg(F.max(place)["value"].alias("value"))
            .filter("value is not null"))
    if opening is None:
        return last
    both = last.withColumn("__new", F.lit(1)).unionByName(opening.select(*keys, "value").withColumn("__new", F.lit(0)))
    return (both.groupBy(*keys).agg(F.max(F.struct("__new", "value"))["value"].alias("value"))
            .filter("value is not null"))


def _scopes(spark: SparkSession, base: str) -> list[str]:
    """Names of the scopes whose state is stored."""
    sinks.recover_below(spark, base)
    if not sinks.path_exists(spark, base):
        return []
    fs, folder = sinks._fs(spark, base)
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(n.removeprefix("scope=") for n in names if n.startswith("scope="))


def state_before(spark: SparkSession, base: str, scope: str) -> DataFrame | None:
    """The state of the latest scope before ``scope``."""
    earlier = [name for name in _scopes(spark, f"{base}/state") if name < scope]
    if not earlier:
        return None
    return spark.read.parquet(sinks.scope_path(f"{base}/state", {"scope": earlier[-1]}))


def run_scope(df: DataFrame, base: str, scope: str, step: Step, close: Step) -> list[str]:
    """Store ``step``'s rows and ``close``'s state of one scope; returns the later scopes, which should be done again.

    The state is written last: a run that stops before that is done again from the same start."""
    spark = df.sparkSession
    opening = state_before(spark, base, scope)
    with sinks.scratch(spark):
        sinks.replace_scope(step(df, opening), f"{base}/rows", {"scope": scope})
        sinks.replace_scope(close(df, opening), f"{base}/state", {"scope": scope})
    return [name for name in _scopes(spark, f"{base}/state") if name > scope]


def read_scopes(spark: SparkSession, base: str) -> DataFrame:
    """The rows of all scopes."""
    sinks.recover_below(spark, f"{base}/rows")
    return spark.read.parquet(f"{base}/rows").drop("scope")
