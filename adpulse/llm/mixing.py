"""Mixing sources to target weights by systematic sampling, in SQL expressions only.

Sources, ordered by code point with null last, weigh 1, 2, 3, 1, 2, 3, ... and
share the corpus size in proportion.  No source may take more than
``max_repeats`` times its own size; what exceeds that is shared again by
weight.  The shares are the solution of sum(min(level * weight, cap)) = total,
found in one pass over the sources ordered by cap / weight: a prefix of them
is capped and the rest divides what is left.  A source is one row there, so
those two windows see as many rows as there are sources.

Inside a source every document expects ``target / size`` copies.  Documents
are put in a fixed order by size class, the prefix sums of the expected copies
start at one offset per source between 0 and 1, and a document is emitted once
for each integer that its step crosses.  The order by size makes the words
taken come near the target although sizes differ.  Two more steps serve sources
with few or very uneven documents: documents that alone are more than
1 / ``LARGE`` of the target are sampled first, and the others' expected copies
then make up for what those took too much or too little; and of ``OFFSETS``
evenly spaced offsets after the drawn one, the one whose words come nearest the
target is taken.  All draws are hashes of source and id, so reruns agree.

Prefix sums use ranks in two levels: rows are counted per (source, size class,
hash block), at most 256 blocks for each of about 8 classes per power of two
(apart for large documents),
and windows only ever number the rows of one such block; a source that holds a
third of the rows spreads over all its blocks, also when its documents are all
of one size.

Null texts have size 0, a null source is a source of its own, a source without
words gets target 0 and takes nothing.  Rows that repeat everything take
neighbouring places and are counted apart.  Empty tables give empty results.
Only ``doc_id``, ``text`` and ``source`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adpulse.llm.common import n_words, numbered, stored, text_or_empty, unused

MAX_REPEATS = 3
SEED = "mix"
OFFSETS = 32
LARGE = 16


def source_targets(sizes: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source, source_size, target`` from ``source, size`` rows."""
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    everything = Window.partitionBy(F.lit(0))
    in_order = everything.orderBy(F.col("source").asc_nulls_last())
    per = (per.withColumn("weight", ((F.row_number().over(in_order) - 1) % 3 + 1).cast("long"))
           .withColumn("cap", F.col("source_size") * max_repeats))
    # Compared as cap / weight with whole numbers: cap * 6 / weight is one.
    by_level = everything.orderBy(F.expr("cap * 6 div weight"), F.col("source").asc_nulls_last())
    capped_to = by_level.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per = per.withColumns({
        "__total": F.sum("source_size").over(everything),
        "__caps": F.sum("cap").over(capped_to), "__weights": F.sum("weight").over(everything),
        "__done": F.sum("weight").over(capped_to)})
    # Before this row: what is left for this and all later rows, by their weights.
    left = F.col("__total") - (F.col("__caps") - F.col("cap"))
    weights = F.col("__weights") - (F.col("__done") - F.col("weight"))
    per = per.withColumns({"__left": left, "__rest": weights,
                           "__over": F.col("cap") * weights <= left * F.col("weight")})
    # Once a row is not capped, no later one is; the first of them, with most left, sets the level.
    per = per.withColumns({
        "__left": F.max(F.when(~F.col("__over"), F.col("__left"))).over(everything),
        "__rest": F.max(F.when(~F.col("__over"), F.col("__rest"))).over(everything)})
    target = (F.when(F.col("__over"), F.col("cap").cast("double"))
              .otherwise((F.col("weight") * F.col("__left")).cast("double") / F.col("__rest").cast("double")))
    return per.select("source", "source_size", target.alias("target"))


def _offset(source: Column) -> Column:
    """Between 0 and 1, from the first 32 bits of the source's hash."""
    digest = F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(source, F.lit("\u0000"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def _size_class(size: Column) -> Column:
    """About eight classes for each power of two, in order of size."""
    bits = F.length(F.bin(size))
    top = F.when(bits > 4, F.expr("shiftright(size, cast(length(bin(size)) - 4 as int))")).otherwise(size)
    return (F.greatest(bits - F.lit(4), F.lit(0)) * 8 + top).cast("int")


def systematic_copies(docs: DataFrame, max_repeats: int = MAX_REPEATS, row: str | None = None) -> DataFrame:
    """``row_id, doc_id, size, source, source_size, target, copies`` of every row; ``row_id`` is
    the column ``row`` of a ``numbered`` table, or else a number that only this result knows."""
    text = text_or_empty()
    rows = stored(docs.select((F.col(row) if row else F.monotonically_increasing_id()).alias("row_id"),
                              F.col("doc_id").cast("long").alias("doc_id"),
                              F.col("source").cast("string").alias("source"),
                              n_words(text).alias("size")), "sizes")
    targets = source_targets(rows, max_repeats)
    targets = targets.withColumnRenamed("source", "__s")
    rows = rows.join(targets, F.col("source").eqNullSafe(F.col("__s"))).drop("__s").withColumns({
        "large": F.col("size") * LARGE > F.col("target"),
        "__digest": F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary")),
        "__class": _size_class(F.col("size"))})
    rows = rows.withColumn("__block", F.substring("__digest", 1, 2))
    blocks = rows.groupBy("source", "large", "__class", "__block").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("source", "large").orderBy("__class", "__block")
    blocks = (blocks.withColumn("__first", F.sum("__n").over(before) - F.col("__n"))
              .select(F.col("source").alias("__s"), F.col("large").alias("__l"), F.col("__class").alias("__c"),
                      F.col("__block").alias("__b"), "__first"))
    inside = Window.partitionBy("source", "large", "__class", "__block").orderBy("size", "__digest", "doc_id", "row_id")
    ranked = stored(rows.withColumn("__i", F.row_number().over(inside)).join(
        blocks, F.col("source").eqNullSafe(F.col("__s")) & (F.col("large") == F.col("__l"))
        & (F.col("__class") == F.col("__c")) & (F.col("__block") == F.col("__b")))
        .select("row_id", "doc_id", "size", "source", "source_size", "target", "large",
                (F.col("__first") + F.col("__i")).alias("rank")), "ranked")

    def copies(rate: Column, offset: Column) -> Column:
        upto, below = F.floor(F.col("rank") * rate + offset), F.floor((F.col("rank") - 1) * rate + offset)
        return (upto - below).cast("long")

    def candidate(i: int) -> Column:
        shifted = _offset(F.col("source")) + F.lit(i / OFFSETS)
        return F.when(shifted >= 1, shifted - 1).otherwise(shifted)

    def with_sources(per_source: DataFrame) -> DataFrame:
        per_source = per_source.withColumnRenamed("source", "__s")
        return ranked.join(per_source, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    large = F.when(F.col("large"), copies(rate, _offset(F.col("source"))))
    sampled = ranked.groupBy("source", "target").agg(
        F.sum(F.coalesce(large * F.col("size"), F.lit(0))).alias("taken"),
        F.sum(F.when(F.col("large"), 0).otherwise(F.col("size"))).alias("left"))
    rest = (F.col("target") - F.col("taken")) / F.col("left")
    rest = F.least(F.lit(float(max_repeats)), F.greatest(F.lit(0.0), rest))
    rates = sampled.select("source", "taken", F.when(F.col("left") > 0, rest).otherwise(F.lit(0.0)).alias("rate"))
    small = F.when(F.col("large"), 0).otherwise(F.col("size"))
    tried = with_sources(rates).groupBy("source", "target", "taken", "rate").agg(*(
        F.sum(small * copies(F.col("rate"), candidate(i))).alias(f"w{i}") for i in range(OFFSETS)))
    best = F.array_min(F.array(*(F.struct(
        F.abs(F.col("taken") + F.col(f"w{i}") - F.col("target")).alias("miss"), F.lit(i).alias("i"),
        candidate(i).alias("offset")) for i in range(OFFSETS))))
    chosen = tried.select("source", "rate", best["offset"].alias("offset"))
    return (with_sources(chosen)
            .withColumn("copies", F.coalesce(large, copies(F.col("rate"), F.col("offset"))))
            .select("row_id", "doc_id", "size", "source", "source_size", "target", "copies"))


def mix(docs: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The mixed corpus: rows of ``docs``, each as often as it is taken."""
    row, copies, copy = unused(docs, "__row", "__copies", "__copy")
    marked = numbered(docs, row)
    taken = (systematic_copies(marked, max_repeats, row).filter(F.col("copies") > 0)
             .select(F.col("row_id").alias(row), F.col("copies").alias(copies)))
    return (marked.join(taken, row)
            .withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
            .drop(row, copies, copy))
