"""From raw documents to packed training sequences in five stages.

Every stage is a function ``(spark, docs, sf_dir) -> DataFrame`` over all that
the stage before kept.  ``run`` writes each result as Parquet in the shared
folder and reads it again, so a lost executor never recomputes an earlier
stage.  All but the last stage return the columns of ``docs``.

1. language: documents whose language the classifier rejects go;
2. exact_dedup: of equal texts (white space aside) the smallest id stays;
3. near_dedup: of documents linked by 5-word shingles at 0.8 the smallest id stays;
4. mixing: each document comes as often as its source's target weight asks;
5. packing: sequences of 2048 tokens, one row per piece of a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adpulse.llm.exact_dedup import keep_first_copies
from adpulse.llm.langid import keep_identified
from adpulse.llm.mixing import mix
from adpulse.llm.near_dedup import keep_one_of_each
from adpulse.llm.packing import pack
from adpulse.sources import sinks


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_first_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [("language", language), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing),
          ("packing", packing)]

#: A trained classifier and a tokenizer have no SQL; tests/llm holds the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = sinks.scratch_path(spark, f"stage-{name}")
        with sinks.scratch(spark):  # what a stage stores on its way goes once its result is written
            found = stage(spark, docs, sf_dir)
            found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
        if before is not None:
            sinks.delete(spark, before)
        before = path
    return docs
