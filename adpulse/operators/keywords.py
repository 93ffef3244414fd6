"""Texts that hold a keyword of a table (P17), as joins instead of one pattern.

A pattern of all keywords stands in the plan and is tried at every character, so it
cannot grow.  Here keywords are data:

1. a keyword's longest part without white space is its anchor; a text that holds the
   keyword has a word that holds the anchor;
2. words of the corpus, each different one once, are cut into grams of ``GRAM``
   characters (and shorter ones, for shorter anchors); those that an anchor has are stored
   and counted; an anchor is joined by the rarest of its grams, and ``contains`` settles the pair;
3. the words found, stored with their keywords, are joined with the texts that hold them (a
   small table of them without shuffling the words of all texts), and keywords of several
   parts are looked for in those texts as they are written.

Matching ignores case (both sides are lower-cased) and finds parts of words, as the
pattern ``a|b|c`` does.  Keywords are plain text.  Null and blank keywords match
nothing, repeated ones count once; null texts hold none.  Texts are known by a
SHA-256 of their lower-cased letters, so equal texts are worked on once and rows need
no id of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.sources.sinks import materialize

GRAM = 3
#: White space that separates words: of the characters that Java's \\s names.
_SPACE = r"\s+"


def _key(text: str) -> Column:
    return F.unhex(F.sha2(F.lower(F.col(text)).cast("binary"), 256))


def _grams(word: str, lengths: str) -> Column:
    """Different runs of as many characters as each of ``lengths`` says; slices of the letters, so that
    a long word takes time in proportion to its length."""
    runs = (f"flatten(transform({lengths}, g -> transform(if(length({word}) >= g, sequence(1, length({word}) - g + 1),"
            f" cast(array() as array<int>)), i -> concat_ws('', slice(__letters, i, g)))))")
    return F.array_distinct(F.expr(runs))


def _anchored(keywords: DataFrame, column: str) -> DataFrame:
    """``keyword, anchor, phrase`` of the keywords that are not blank."""
    low = keywords.select(F.lower(F.col(column)).alias("keyword")).filter("length(regexp_replace(keyword, '\\\\s', '')) > 0").distinct()
    parts = low.withColumn("__parts", F.split("keyword", _SPACE))
    longest = F.expr("reduce(__parts, '', (a, x) -> if(length(x) > length(a), x, a))")
    return parts.select("keyword", longest.alias("anchor"), F.col("keyword").rlike(r"\s").alias("phrase"))


def keyword_hits(texts: DataFrame, keywords: DataFrame, text: str = "text", column: str = "keyword") -> DataFrame:
    """``text_key, keyword``: every different text and every keyword in it, once."""
    low = texts.filter(F.col(text).isNotNull()).select(_key(text).alias("text_key"), F.lower(F.col(text)).alias("__text"))
    words = low.select("text_key", F.explode(F.array_distinct(F.split("__text", _SPACE))).alias("word")).filter("word <> ''")
    vocabulary = words.select("word").distinct().withColumn("__letters", F.split("word", ""))
    every = f"sequence(1, {GRAM})"
    anchored = materialize(_anchored(keywords, column), "keywords")
    own = materialize(anchored.select("anchor").distinct().withColumn("__letters", F.split("anchor", ""))
                      .select("anchor", F.explode(_grams("anchor", f"array(least(length(anchor), {GRAM}))")).alias("gram")), "anchor-grams")
    grams = vocabulary.select("word", F.explode(_grams("word", every)).alias("gram"))
    grams = materialize(grams.join(own.select("gram").distinct(), "gram", "left_semi"), "word-grams")
    counts = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    # A gram that no word has leaves its anchor without a partner, so an inner join loses nothing.
    rarest = own.join(counts, "gram").groupBy("anchor").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"))
    holding = grams.join(rarest, "gram").filter(F.contains("word", "anchor")).select("word", "anchor")
    holding = materialize(holding.join(anchored, "anchor").select("word", "keyword", "phrase"), "word-keywords")
    # Stored: single words and phrases read it, and the texts are split for it.
    found = materialize(words.join(holding, "word").select("text_key", "keyword", "phrase").distinct(), "keyword-words")
    single = found.filter("not phrase").select("text_key", "keyword")
    several = (found.filter("phrase").join(low, "text_key").filter(F.contains("__text", "keyword"))
               .select("text_key", "keyword").distinct())
    return single.unionByName(several)


def keyword_flags(df: DataFrame, keywords: DataFrame, text: str = "text", column: str = "keyword",
                  out: str = "has_keyword") -> DataFrame:
    """``df`` with a boolean: the text holds a keyword of the table.  A null text gives false."""
    hits = keyword_hits(df, keywords, text, column).select(F.col("text_key").alias("__hit")).distinct()
    return (df.withColumn("__key", _key(text)).join(hits, F.col("__key") == F.col("__hit"), "left")
            .withColumn(out, F.col("__hit").isNotNull()).drop("__key", "__hit"))
