"""Joins whose fan-out stays even when a key holds most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Joined rows of one (key, salt), by default, and how many keys may be salted at most.
PER_TASK = 1_000_000
HEAVY_KEYS = 10_000


def heavy_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], per_task: int = PER_TASK) -> DataFrame:
    """``keys, salts`` of the keys whose join gives more than ``per_task`` rows: into
    how many parts their left rows are to be dealt.

    Both sides are counted by aggregates that combine before the shuffle.  The
    limit is raised so that at most ``HEAVY_KEYS`` keys exceed it, whatever the
    size of the data, which makes the result safe to broadcast.
    """
    counts = (left.groupBy(*keys).agg(F.count(F.lit(1)).alias("__l"))
              .join(right.groupBy(*keys).agg(F.count(F.lit(1)).alias("__r")), list(keys))
              .select(*keys, (F.col("__l").cast("double") * F.col("__r")).alias("__rows"), "__l"))
    least = counts.agg(F.greatest(F.lit(float(per_task)), F.sum("__rows") / HEAVY_KEYS)).scalar()
    # More parts than left rows would only copy the right side.
    salts = F.least(F.ceil(F.col("__rows") / least), F.col("__l"))
    return counts.filter(F.col("__rows") > least).select(*keys, salts.cast("int").alias("salts"))


def balanced_join(left: DataFrame, right: DataFrame, keys: Sequence[str], salt_by: Sequence[str],
                  per_task: int = PER_TASK, heavy: DataFrame | None = None) -> DataFrame:
    """Inner equi-join on ``keys``; both sides should be stored tables, as they are read
    twice, unless the result of ``heavy_keys`` is given.

    Left rows of a heavy key are dealt to salts by the hash of ``salt_by`` and
    the right rows of that key are copied once per salt; all other keys have the one
    salt 0, so their join is a plain one.  The result is that of
    ``left.join(right, keys)``, and no (key, salt) gives much more than ``per_task`` rows,
    whether or not the run-time skew join is on.
    """
    if heavy is None:
        heavy = F.broadcast(heavy_keys(left, right, keys, per_task))  # at most HEAVY_KEYS rows
    salts = F.coalesce("salts", F.lit(1))
    dealt = (left.join(heavy, list(keys), "left")
             .withColumn("__salt", F.pmod(F.xxhash64(*salt_by), salts).cast("int")).drop("salts"))
    copied = (right.join(heavy, list(keys), "left")
              .withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts"))
    return dealt.join(copied, [*keys, "__salt"]).drop("__salt")


def grid_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_by: Sequence[str], right_by: Sequence[str],
              per_task: int = PER_TASK) -> DataFrame:
    """As ``balanced_join`` for keys that may be heavy on either side: for each heavy key the side
    with more rows is dealt out and the other copied.  Both sides must be stored tables."""
    counts = (left.groupBy(*keys).agg(F.count(F.lit(1)).alias("__l"))
              .join(right.groupBy(*keys).agg(F.count(F.lit(1)).alias("__r")), list(keys))
              .withColumn("__rows", F.col("__l").cast("double") * F.col("__r")))
    least = counts.agg(F.greatest(F.lit(float(per_task)), F.sum("__rows") / HEAVY_KEYS)).scalar()
    parts = F.least(F.ceil(F.col("__rows") / least), F.greatest("__l", "__r")).cast("int")
    wide = F.col("__l") >= F.col("__r")
    heavy = F.broadcast(counts.filter(F.col("__rows") > least).select(  # at most HEAVY_KEYS rows
        *keys, F.when(wide, parts).otherwise(1).alias("__ln"), F.when(wide, 1).otherwise(parts).alias("__rn")))

    def dealt(df: DataFrame, by: Sequence[str], own: str, other: str) -> DataFrame:
        n, copies = F.coalesce(f"__{own}n", F.lit(1)), F.coalesce(f"__{other}n", F.lit(1))
        return (df.join(heavy, list(keys), "left")
                .withColumn(f"__{own}salt", F.pmod(F.xxhash64(*by), n).cast("int"))
                .withColumn(f"__{other}salt", F.explode(F.sequence(F.lit(0), copies - 1))).drop("__ln", "__rn"))
    at = [*keys, "__lsalt", "__rsalt"]
    return dealt(left, left_by, "l", "r").join(dealt(right, right_by, "r", "l"), at).drop("__lsalt", "__rsalt")
