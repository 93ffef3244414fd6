"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.sources.sinks import materialize as stored  # noqa: F401  (written to the shared folder, read back)

#: The white space of the contracts: space and the ASCII controls 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Rows for which one Python task keeps state in memory.
ROWS_PER_TASK = 250_000

#: Rows of an Arrow batch that holds whole texts.
TEXT_BATCH = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def n_words(text):
    """Number of maximal runs of non-space characters, from the number of separators."""
    squeezed = F.trim(F.regexp_replace(text, SPACE, " "))
    return (F.when(squeezed == "", F.lit(0))
            .otherwise(F.length(squeezed) - F.length(F.replace(squeezed, F.lit(" "), F.lit(""))) + 1)
            .cast("long"))


def parts_for(rows: int, per_task: int = ROWS_PER_TASK) -> int:
    """Partitions that keep a Python task at ``per_task`` rows, whatever the input."""
    return max(1, -(-rows // per_task))


def numbered(docs: DataFrame, row: str) -> DataFrame:
    """``docs`` stored once with a number for each row in ``row``.  All that follows must read this
    table: a number that a second scan gives is another one when files are split otherwise, as
    happens when executors join or leave."""
    return stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until no column of ``df`` has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
