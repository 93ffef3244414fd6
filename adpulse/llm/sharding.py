"""Sharding by jump consistent hashing, in SQL expressions only.

A stable key (here the document id) seeds a linear congruential generator
with 64-bit arithmetic; the shard is the last jump below the shard count.
Adding a shard moves only the keys whose next jump lands on it.  There is no
ring table to store or to broadcast.

Spark raises an error when a long overflows, so the 64-bit product is taken
in three limbs of 24, 20 and 20 bits, each of which stays far below 2^63.

Positions inside a shard are numbered in two levels: rows are counted per
(shard, first 12 bits of the key's hash), a table of at most 4096 rows per
shard, whose prefix sums give each such block its first slot; the window that
numbers rows only ever holds one block.  Equal texts need no special care, as
only the id decides; a text that repeats spreads like any other.

A null id is one key of its own (all such rows share a shard).  Empty tables
give empty results.  Rows that repeat id and text get different slots, and as
they are equal it does not matter which gets which.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adpulse.llm.common import text_or_empty

#: The multiplier of the published jump hash.
_MULTIPLIER = 2862933555777941757
_M0, _M1, _M2 = _MULTIPLIER & 0xFFFFFF, (_MULTIPLIER >> 24) & 0xFFFFF, _MULTIPLIER >> 44
#: Jumps tried for every row; the few rows that need more take the full walk.
_USUAL_JUMPS = 48
#: Hex digits of the key's hash that name a block of rows inside a shard.
_BLOCK_DIGITS = 3


def key_hash(key: Column) -> Column:
    """32 hex digits that depend on the key's value alone."""
    return F.md5(F.coalesce(key.cast("string"), F.lit("null")).cast("binary"))


def jump_shard(digest: Column, shards: int) -> Column:
    """The jump hash of the first 64 bits of ``digest`` (hex) for ``shards``."""
    if shards < 1:
        raise ValueError("at least one shard is needed")

    def limb(start: int, digits: int) -> Column:
        return F.conv(F.substring(digest, start, digits), 16, 10).cast("long")

    def walk(jumps: int) -> Column:
        start = F.struct(F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"),
                         limb(11, 6).alias("k0"), limb(6, 5).alias("k1"), limb(1, 5).alias("k2"))

        def step(s: Column, _: Column) -> Column:
            p0 = s["k0"] * F.lit(_M0) + 1
            p1 = s["k0"] * F.lit(_M1) + s["k1"] * F.lit(_M0) + F.shiftright(p0, 24)
            p2 = (s["k0"] * F.lit(_M2) + s["k2"] * F.lit(_M0)
                  + F.shiftleft(s["k1"] * F.lit(_M1), 4) + F.shiftright(p1, 20))
            k0, k1, k2 = p0.bitwiseAND(0xFFFFFF), p1.bitwiseAND(0xFFFFF), p2.bitwiseAND(0xFFFFF)
            top = F.shiftleft(k2, 11) + F.shiftright(k1, 9) + 1
            jump = F.floor((s["j"] + 1) * (F.lit(float(1 << 31)) / top.cast("double"))).cast("long")
            return F.when(s["j"] >= shards, s).otherwise(
                F.struct(s["j"].alias("b"), jump.alias("j"), k0.alias("k0"), k1.alias("k1"), k2.alias("k2")))
        return F.aggregate(F.sequence(F.lit(1), F.lit(jumps)), start, step)

    usual = walk(min(shards, _USUAL_JUMPS))
    if shards <= _USUAL_JUMPS:
        return usual["b"].cast("int")
    return F.when(usual["j"] >= shards, usual["b"]).otherwise(walk(shards)["b"]).cast("int")


def numbered(df: DataFrame, group: str, digest: str, order: list[str], name: str) -> DataFrame:
    """Add ``name``: 0, 1, ... inside each ``group``, by ``digest`` and ``order``."""
    block = F.substring(F.col(digest), 1, _BLOCK_DIGITS)
    df = df.withColumn("__block", block)
    # At most 16^3 rows for each group.
    first = (df.groupBy(F.col(group).alias("__g"), F.col("__block").alias("__b")).agg(F.count(F.lit(1)).alias("__n"))
             .withColumn("__first", F.sum("__n").over(Window.partitionBy("__g").orderBy("__b")) - F.col("__n"))
             .drop("__n"))
    inside = Window.partitionBy(group, "__block").orderBy(F.col(digest), *order)
    return (df.withColumn("__i", F.row_number().over(inside))
            .join(first, (F.col(group) == F.col("__g")) & (F.col("__block") == F.col("__b")))
            .withColumn(name, (F.col("__first") + F.col("__i") - 1).cast("long"))
            .drop("__block", "__g", "__b", "__first", "__i"))


def assign_shards(docs: DataFrame, shards: int = 16) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row.

    ``size`` is the UTF-8 length of the text plus one, ``grown_shard`` the shard
    that the row would have with one shard more.
    """
    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"),
                       key_hash(F.col("doc_id")).alias("digest"))
    rows = rows.withColumns({"shard": jump_shard(F.col("digest"), shards),
                             "grown_shard": jump_shard(F.col("digest"), shards + 1)})
    out = numbered(rows, "shard", "digest", ["doc_id", "text_crc32", "size"], "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
