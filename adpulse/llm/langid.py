"""Language identification by nearest centroid.

A text becomes the hashed counts of its character n-grams (one to three lower-case
letters, with word borders), damped by a logarithm, weighted by inverse
document frequency and scaled to length one.  Every language has several
centroids from spherical k-means; a text takes the language of the centroid
with the largest cosine.  How near a text of a language comes depends on its
length, so excerpts of the training sample of every power of two of length give, for
each language and length, the cosine that all but ``FARTHEST`` of them reach; a text that
stays below ``REJECT`` times that is too far from everything learned and is rejected.
Texts shorter than ``2 ** SHORTEST`` characters say too little and are not rejected.

Fitting: document frequencies come from all training rows.  Centroids come from
a sample of ``SAMPLE`` texts of each language, those with the smallest text
hash, so a language's task holds at most that many vectors.  The hashes are first cut
to a few times as many by the language's approximate number of texts, so no task
ranks all of a language's.  What the driver
and the tasks share is one weight per dimension and ``CENTROIDS`` vectors per
language, whatever the number of rows.

Texts of any length are counted in slices of ``SLICE`` characters.  Null texts and texts without a letter get ``und``, score 0, and are rejected.
Without training rows every text does.  Rows with a null language are not
learned from but classified.  Repeated rows are classified alike.  Only
``doc_id``, ``text`` and, for fitting, ``lang`` are read.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adpulse.llm.common import stored, unused

DIMENSIONS = 1 << 14
SAMPLE = 1000
CENTROIDS = 4
REJECT = 0.9
FARTHEST = 0.002
#: Powers of two of lengths with thresholds of their own.
SHORTEST, LONGEST = 5, 13
SLICE = 1 << 20
ROUNDS = 8
UNKNOWN = "und"


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Hashed n-gram counts of a whole text; None if it has no letter."""
    if not text:
        return None
    total, seen, before, after_letter = np.zeros(DIMENSIONS, np.int64), False, np.zeros(1, np.uint32), False
    for at in range(0, len(text), SLICE):
        c = np.frombuffer(text[at:at + SLICE].lower().encode("utf-32-le", "replace"), np.uint32)
        letter = _letters()[c]
        seen |= bool(letter.any())
        # Every run of other characters is one border; the text starts and ends with one.
        keep = letter | np.concatenate(([after_letter], letter[:-1]))
        after_letter = bool(letter[-1])
        c = np.where(letter, c, 0)[keep]
        if at + SLICE >= len(text):
            c = np.concatenate((c, np.zeros(1, np.uint32)))
        total += _grams(np.concatenate((before, c)), len(before) if at else 0)
        before = np.concatenate((before, c))[-2:]
    return total if seen else None


def _grams(c: np.ndarray, known: int) -> np.ndarray:
    """Hashed counts of the one to three characters that end after the first ``known`` ones."""
    c = c.astype(np.uint64)
    mixed = c * np.uint64(0x9E3779B97F4A7C15)
    two = (mixed[:-1] ^ (mixed[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + mixed[1:]
    three = (two[:-1] ^ (two[:-1] >> np.uint64(32))) * np.uint64(0x94D049BB133111EB) + mixed[2:]
    grams = np.concatenate((mixed[known:], two[max(0, known - 1):], three[max(0, known - 2):]))
    grams ^= grams >> np.uint64(31)
    grams *= np.uint64(0xD6E8FEB86659FD93)
    return np.bincount((grams >> np.uint64(40)).astype(np.int64) % DIMENSIONS, minlength=DIMENSIONS)


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=-1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return _unit(np.log1p(counts) * idf).astype(np.float32)


def _clustered(idf: np.ndarray):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """Spherical k-means over one language's sample, begun from members alike in distance to the mean."""
        pdf = pdf.sort_values("order")
        x = [vector(c, idf) for c in map(ngram_counts, pdf["text"]) if c is not None]
        if not x:
            return pd.DataFrame({"lang": [], "centroid": [], "lowest": []})
        x = np.stack(x)
        ranked = np.array_split((x @ _unit(x.mean(axis=0))).argsort(kind="stable"), min(CENTROIDS, len(x)))
        centres = np.stack([_unit(x[members].mean(axis=0)) for members in ranked])
        for _ in range(ROUNDS):
            near = (x @ centres.T).argmax(axis=1)
            centres = np.stack([_unit(x[near == k].mean(axis=0)) if (near == k).any() else centres[k]
                                for k in range(len(centres))])
        lowest = _lowest(pdf["text"], idf, centres)
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "centroid": [c.tolist() for c in centres], "lowest": [lowest] * len(centres)})
    return run


def _band(counts: np.ndarray) -> int:
    """The power of two of a text's length in letters and borders."""
    return min(LONGEST, int(counts.sum() // 3).bit_length() - 1)


def _lowest(texts: Iterable[str], idf: np.ndarray, centres: np.ndarray) -> list[float]:
    """For each length the cosine that nearly all excerpts of it reach; never more than that of longer ones."""
    found: dict[int, list[float]] = {}
    for i, text in enumerate(texts):
        for power in range(SHORTEST, LONGEST + 1):
            size = (1 << power) + (1 << power) // 4  # white space runs are one border
            if len(text) < size:
                size = len(text)
            at = (i * 2654435761 + power) % (len(text) - size + 1)
            counts = ngram_counts(text[at:at + size])
            if counts is not None:
                found.setdefault(_band(counts), []).append(float((centres @ vector(counts, idf)).max()))
            if size == len(text):
                break
    low, least = [0.0] * (LONGEST + 1), 1.0
    for power in range(LONGEST, -1, -1):
        if power in found and power >= SHORTEST:
            least = min(least, float(np.quantile(found[power], FARTHEST)))
            low[power] = least
        elif power >= SHORTEST:
            low[power] = 0.0 if least == 1.0 else least
    # Lengths beyond the sample's own take the threshold of its longest.
    for power in range(SHORTEST + 1, LONGEST + 1):
        low[power] = low[power] or low[power - 1]
    return low


def _document_frequencies(batches):
    total, n = np.zeros(DIMENSIONS, np.int64), 0
    for batch in batches:
        for text in batch.column("text"):
            counts = ngram_counts(text.as_py())
            if counts is not None:
                total += counts > 0
                n += 1
    # Dimension -1 carries the number of texts.
    yield pa.record_batch([pa.array(np.arange(-1, DIMENSIONS)), pa.array(np.concatenate(([n], total)))],
                          names=["dimension", "df"])


@dataclass
class LanguageModel:
    idf: np.ndarray
    langs: list[str]
    centroids: np.ndarray
    lowest: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        counts = ngram_counts(text) if self.langs else None
        if counts is None:
            return UNKNOWN, 0.0, True
        at = np.flatnonzero(counts)
        weight = np.log1p(counts[at]) * self.idf[at]
        cosines = self.centroids[:, at] @ weight / np.linalg.norm(weight)
        best = int(cosines.argmax())
        score = min(max(float(cosines[best]), 0.0), 1.0)
        return self.langs[best], score, score < REJECT * float(self.lowest[best, _band(counts)])


def fit(training: DataFrame) -> LanguageModel:
    """Learn from rows ``text, lang`` with a language."""
    rows = training.filter("lang is not null and text is not null").select("text", "lang")
    by_dimension = (rows.select("text").mapInArrow(_document_frequencies, "dimension long, df long")
                    .groupBy("dimension").agg(F.sum("df").alias("df")))
    df = np.zeros(DIMENSIONS + 1)
    for dimension, n in by_dimension.collect():  # one row per dimension
        df[dimension + 1] = n
    idf = np.log((1 + df[0]) / (1 + df[1:])) + 1
    # The sample is found by hashes alone; only its texts are moved, and copies of one text once.
    keyed = rows.withColumn("order", F.xxhash64("text"))
    by_hash = Window.partitionBy("lang").orderBy("order")
    # Hashes are even over all longs: below this bound lie about four times the sample.
    bound = (F.least(F.lit(1.0), 4.0 * SAMPLE / F.greatest(F.lit(1), F.approx_count_distinct("order"))) * 2 - 1) * float(1 << 63)
    bounds = stored(keyed.groupBy("lang").agg(bound.alias("bound")), "bounds")
    few = keyed.select("lang", "order").join(bounds, "lang").filter(F.col("order").cast("double") <= F.col("bound"))
    cut = stored(few.select("lang", "order").distinct().withColumn("place", F.row_number().over(by_hash))
                 .filter(F.col("place") <= SAMPLE).groupBy("lang").agg(F.max("order").alias("cut")), "cut")
    sample = (keyed.join(cut, "lang").filter(F.col("order") <= F.col("cut"))
              .groupBy("lang", "order").agg(F.first("text").alias("text")))
    found = sample.groupBy("lang").applyInPandas(_clustered(idf), "lang string, centroid array<float>, lowest array<double>")
    learned = stored(found, "centroids").orderBy("lang", "lowest").collect()  # CENTROIDS rows per language
    return LanguageModel(idf, [r["lang"] for r in learned],
                         np.array([r["centroid"] for r in learned], np.float32).reshape(-1, DIMENSIONS),
                         np.array([r["lowest"] for r in learned]).reshape(-1, LONGEST + 1))


def _predicted(model: LanguageModel, texts):
    lang, score, rejected = zip(*map(model.predict, texts), strict=True) if len(texts) else ((), (), ())
    return [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())]


def with_language(docs: DataFrame, model: LanguageModel, added: list[str], text: str = "text") -> DataFrame:
    """``docs`` with language, score and rejection in the columns ``added``; all columns are kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            cols = _predicted(shared.value, batch.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays(batch.columns + cols, names=batch.schema.names + added)
    kinds = (T.StringType(), T.DoubleType(), T.BooleanType())
    schema = T.StructType([*docs.schema.fields, *map(T.StructField, added, kinds)])
    return docs.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """True for ids whose CRC-32, as text, leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected``, learned from the rows that are not held out."""
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       held_out(F.col("doc_id")).alias("held_out"))
    return with_language(rows, model, ["lang_pred", "score", "rejected"]).drop("text")


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose language the classifier rejects."""
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    added = unused(docs, "__lang", "__score", "__rejected")
    return with_language(docs, model, added).filter(~F.col(added[2])).drop(*added)
