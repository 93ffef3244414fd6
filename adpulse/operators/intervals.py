"""Joins of periods that overlap (J2 with an end date): campaign periods against job periods.

An inequality join would compare every pair of a key's periods.  Here a period
lives at the level of its length: at level ``l`` bins are ``2**l`` units wide and
no narrower than the period, so it touches two bins at most.  Of two periods the
longer one waits in its own bins and the shorter one looks into the bins of that
level, again two at most, for every level at which the other side has periods of
the same keys.  So bin widths follow the lengths that are there, all joins are equi-joins on
(keys, level, bin), and a period that spans everything costs one more row per
period of its keys on the other side, not a copy of itself per day.  Periods whose
keys the other side does not have are left out before anything is copied.

A pair that shares two bins is kept in the one that holds the later start.
Bins in which very many pairs meet are dealt out by ``skew.grid_join``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.operators.skew import PER_TASK, grid_join
from adpulse.sources import sinks

_LEVELS = 63


def _units(df: DataFrame, name: str) -> Column:
    """A date as days, a timestamp as microseconds, a whole number as it is."""
    kind = dict(df.dtypes)[name]
    if kind == "date":
        return F.unix_date(name).cast("long")
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(name).cast("timestamp"))
    return F.col(name).cast("long")


def _periods(df: DataFrame, span: tuple[str, str], keys: Sequence[str], side: str, last: Column) -> DataFrame:
    """``df`` with start, end and level; periods without a start, a key or any day go."""
    s, e, level = f"__{side}s", f"__{side}e", f"__{side}level"
    df = df.dropna(subset=list(keys)).withColumns({s: _units(df, span[0]), e: F.coalesce(_units(df, span[1]), last)})
    df = df.filter(F.col(s) <= F.col(e))
    length = F.col(e) - F.col(s)
    return df.withColumn(level, F.when(length == 0, 0).otherwise(F.length(F.bin(length))))


def _levels(periods: DataFrame, side: str, keys: Sequence[str]) -> DataFrame:
    """``keys, __levels``: the levels that occur, as the bits of one number."""
    return periods.groupBy(*keys).agg(F.bit_or(F.expr(f"shiftleft(1L, __{side}level)")).alias("__levels"))


def _placed(periods: DataFrame, side: str, own: str, other: str, other_levels: DataFrame, keys: Sequence[str],
            least: int) -> DataFrame:
    """One row per bin: where a period waits (``own``) and where it looks (``other``), from
    ``least`` levels above its own on."""
    level, s, e = F.col(f"__{side}level"), F.col(f"__{side}s"), F.col(f"__{side}e")
    looks = F.filter(F.sequence(F.lit(0), F.lit(_LEVELS - 1)),
                     lambda at: (F.getbit("__levels", at) == 1) & (at >= level + least))
    places = F.concat(F.array(F.struct(level.alias("level"), F.lit(own).alias("waits"))),
                      F.transform(looks, lambda at: F.struct(at.alias("level"), F.lit(other).alias("waits"))))
    met = periods.join(other_levels, list(keys)) if keys else periods.crossJoin(other_levels)
    rows = met.withColumn("__place", F.explode(places))
    rows = rows.withColumns({"__level": F.col("__place.level"), "__waits": F.col("__place.waits")})
    first, last = (F.call_function("shiftright", x, F.col("__level")) for x in (s, e))
    return rows.withColumn("__bin", F.explode(F.sequence(first, last))).drop("__place", "__levels", f"__{side}level")


def overlap_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_span: tuple[str, str],
                 right_span: tuple[str, str], per_task: int = PER_TASK) -> DataFrame:
    """Inner join on ``keys`` of the rows whose periods share a day (or unit): the
    columns of ``left``, then those of ``right`` without the keys.

    Periods are closed.  A null end is open: it reaches the last start or end of
    either side.  Rows with a null start or key, or an end before the start, meet
    nothing.  Repeated rows count apart.  Apart from the keys, names must differ.
    """
    if clash := {c.lower() for c in left.columns} & {c.lower() for c in right.columns} - {k.lower() for k in keys}:
        raise ValueError(f"columns on both sides: {sorted(clash)}")

    def latest(df: DataFrame, span: tuple[str, str]) -> Column:
        return df.agg(F.max(F.greatest(_units(df, span[0]), _units(df, span[1])))).scalar()
    out = [*left.columns, *(c for c in right.columns if c not in keys)]
    last = F.greatest(latest(left, left_span), latest(right, right_span))
    a, b = _periods(left, left_span, keys, "l", last), _periods(right, right_span, keys, "r", last)
    at = [*keys, "__level", "__bin", "__waits"]
    # Stored: counted for the hot bins and joined, the same rows both times.
    a, b = (sinks.materialize(x, name) for x, name in (
        (_placed(a, "l", "left", "right", _levels(b, "r", keys), keys, 1), "periods-left"),
        (_placed(b, "r", "right", "left", _levels(a, "l", keys), keys, 0), "periods-right")))

    def dealt_by(df: DataFrame) -> list[str]:
        # Maps and variants have no hash.
        return [c for c, kind in df.dtypes if c not in at and "map<" not in kind and "variant" not in kind]
    pairs = grid_join(a, b, at, dealt_by(a), dealt_by(b), per_task)
    later = F.greatest("__ls", "__rs")
    return pairs.filter((later <= F.least("__le", "__re"))
                        & (F.call_function("shiftright", later, F.col("__level")) == F.col("__bin"))).select(*out)
