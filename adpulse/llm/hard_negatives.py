"""Hard negatives by inner product, with length buckets and coordinate pruning.

Vectors are scaled to whole numbers, so scores are exact.  They are ranked by
length, longest first, and cut into buckets.  A bucket holds, for every
coordinate, the list of its unit vectors sorted by that coordinate.

For an anchor and a score to reach, a bucket whose longest vector cannot reach
it is left out: these are always the buckets from some place on, found from one
list of bucket lengths.  In the other buckets the score asks for a cosine of at
least t = score / (anchor's length * longest length).  A unit vector at an angle
of at most arccos(t) from the anchor has, in each coordinate, a value within that
angle of the anchor's own.  The anchor's ``FOCUS`` largest coordinates give such
ranges; the sorted list of the narrowest range is cut out and intersected with
the other ranges, and only what is left is verified with the exact score.  The
ranges are widened by more than the arithmetic can err, so no row is lost.

1. Positives: buckets of each label.  The anchor meets its label's longest
   bucket first; the k-th best score found there is what all other buckets must
   reach.  A ranking window takes the best k of all buckets.
2. Negatives: buckets over all labels.  The score to reach is ``LOW`` percent of
   the anchor's weakest usable positive; what is verified is dealt to the bands of
   the positives, of which a bucket gives its best few each.

A task holds one bucket (``COMPONENTS`` numbers) and at most ``ASKED`` anchors: a
bucket that more anchors meet is copied for each further share of them.

No part take rows with a null id, label or vector, an empty vector, null or non-finite
components, or components of ``LARGEST`` or more once scaled (their scores
could leave 64 bits).  Vectors meet only those of the same length (number of
components).  Zero vectors score 0 with all.  "Other rows" are those with
another id; repeated rows are candidates once each, repeated anchors (equal in
all columns) are answered once.  Ties go to the smaller id.  An empty table
gives an empty result.  Only ``vec_id``, ``embedding`` and ``label`` are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adpulse.llm.common import stored
from adpulse.llm.ranking import ranked

SCALE = 256
#: Components of a bucket, and anchors that one task asks it for.
COMPONENTS = 1 << 18
ASKED = 4096
#: Coordinates of an anchor that give ranges.
FOCUS = 4
LARGEST = 1 << 26
POSITIVES = NEGATIVES = 5
#: A score that all rows reach.
ANY = -(1 << 62)
LOW = 80
#: By how much a cosine from rounded numbers may be off, generously.
_SLACK = 1e-9


class LengthBucket:
    """Vectors of similar length with a sorted list for each coordinate."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.floats = vectors.astype(float)
        self.largest = float(np.abs(vectors).max(initial=0)) * vectors.shape[1]
        lengths = np.sqrt((self.floats ** 2).sum(axis=1))
        self.longest = float(lengths.max(initial=0))
        self.unit = vectors / np.where(lengths > 0, lengths, 1)[:, None]
        self.order = np.argsort(self.unit, axis=0)
        self.sorted = np.take_along_axis(self.unit, self.order, axis=0).T.copy()
        self.order = self.order.T.copy()

    def candidates(self, anchor: np.ndarray, length: float, reach: float) -> np.ndarray:
        """Places of all vectors whose product with the anchor can be ``reach`` or more (more than 0)."""
        cosine = reach / (length * self.longest) if length and self.longest else 2.0
        if cosine > 1 + _SLACK:
            return np.zeros(0, np.int64)
        angle = np.arccos(np.clip(cosine - _SLACK, -1, 1)) + 1e-7
        unit = anchor / length
        focus = np.argpartition(-np.abs(unit), min(FOCUS, len(unit)) - 1)[:FOCUS]
        own = np.arccos(np.clip(unit[focus], -1, 1))
        # Zero vectors have no direction, but reach no score above 0 either.
        low, high = np.cos(np.minimum(own + angle, np.pi)) - _SLACK, np.cos(np.maximum(own - angle, 0)) + _SLACK
        first = [self.sorted[f].searchsorted(x) for f, x in zip(focus, low, strict=True)]
        last = [self.sorted[f].searchsorted(x, "right") for f, x in zip(focus, high, strict=True)]
        narrowest = int(np.argmin(np.subtract(last, first)))
        found = self.order[focus[narrowest], first[narrowest]:last[narrowest]]
        for i, f in enumerate(focus):
            if i != narrowest and len(found):
                value = self.unit[found, f]
                found = found[(value >= low[i]) & (value <= high[i])]
        return found

    def scores(self, anchor: np.ndarray, places: np.ndarray | slice) -> np.ndarray:
        if self.largest * float(np.abs(anchor).max(initial=0)) < 1 << 53:  # doubles add such products exactly, and faster
            return (self.floats[places] @ anchor.astype(float)).astype(np.int64)
        return self.vectors[places] @ anchor

    def reaching(self, anchor: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of all vectors that score ``reach`` or more."""
        if reach <= 0:
            places = np.arange(len(self.ids))
            score = self.scores(anchor, slice(None))
        else:
            places = self.candidates(anchor, float(np.sqrt((anchor.astype(float) ** 2).sum())), reach)
            score = self.scores(anchor, places)
        enough = score >= reach
        return places[enough], score[enough]

    def best(self, places: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
        """Indices of the ``k`` first by score, then id."""
        if len(score) > k:
            least = np.partition(score, len(score) - k)[len(score) - k]
            some = np.flatnonzero(score >= least)
        else:
            some = np.arange(len(score))
        return some[np.lexsort((self.ids[places[some]], -score[some]))][:k]


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.int64) for v in column])


def _bucket(pdf: pd.DataFrame) -> LengthBucket:
    return LengthBucket(pdf["vec_id"].to_numpy(), pdf["label"].to_numpy(), _matrix(pdf["vector"]))


def _positives(k: int):
    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(asked):
            bucket = _bucket(rows)
            for key, own, reach, vector in zip(asked["anchor"], asked["anchor_id"], asked["reach"], _matrix(asked["vector"]),
                                               strict=True):
                places, score = bucket.reaching(vector, int(reach))
                other = bucket.ids[places] != own
                places, score = places[other], score[other]
                out += [(key, bucket.ids[places[i]], score[i]) for i in bucket.best(places, score, k)]
        return pd.DataFrame(out, columns=["anchor", "positive_id", "positive_score"])
    return run


def _negatives(k: int, low: int):
    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(asked):
            bucket = _bucket(rows)
            for key, label, reach, bands, vector in zip(asked["anchor"], asked["label"], asked["reach"], asked["bands"],
                                                        _matrix(asked["vector"]), strict=True):
                places, score = bucket.reaching(vector, int(reach))
                other = bucket.labels[places] != label
                places, score = places[other], score[other]
                for positive in {int(p) for p in bands}:
                    inside = np.flatnonzero((100 * score >= low * positive) & (score <= positive))
                    best = inside[bucket.best(places[inside], score[inside], k)]
                    out += [(key, positive, bucket.ids[places[i]], score[i]) for i in best]
        return pd.DataFrame(out, columns=["anchor", "positive_score", "negative_id", "negative_score"])
    return run


def scaled(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, vector`` (whole numbers), ``dim, length`` of the rows that take part."""
    vector = F.col("vector")
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST / SCALE))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.dropna().filter((F.size(vector) > 0) & usable)
    rows = rows.withColumn("vector", F.transform("vector", lambda x: F.floor(x * F.lit(float(SCALE)))))
    squares = F.aggregate("vector", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))
    return rows.withColumns({"dim": F.size("vector"), "length": F.sqrt(squares)})


def _bucketed(rows: DataFrame, group: Column, n: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``kin`` (the group) and ``bucket``, and for each group the
    array ``lengths`` of its buckets' longest vectors, in order."""
    order = [F.col(c) for c in ("length", "vec_id", "label", "vector")]
    dealt = stored(ranked(rows.withColumn("kin", group), "kin", [order[0].desc(), *order[1:]], n)
                   .withColumn("bucket", F.expr(f"rank div greatest(1, {COMPONENTS} div dim)")), "buckets")
    longest = dealt.groupBy("kin", "bucket").agg(F.max("length").alias("length"))
    lengths = longest.groupBy("kin").agg(F.array_sort(F.collect_list(F.struct("bucket", "length"))).alias("b"))
    return dealt, stored(lengths.select("kin", F.transform("b", lambda b: b["length"]).alias("lengths")), "lengths")


def _asked(dealt: DataFrame, questions: DataFrame, run, schema: str) -> DataFrame:
    """``run`` on each bucket and the questions (``kin, bucket`` and more) for it, in shares of about ``ASKED``."""
    per = questions.groupBy("kin", "bucket").agg(F.ceil(F.count(F.lit(1)) / ASKED).alias("shares"))
    keys = ["kin", "bucket", "share"]
    copies = (dealt.select("kin", "bucket", "vec_id", "label", "vector").join(per, ["kin", "bucket"])
              .withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1))).drop("shares"))
    spread = (questions.join(per, ["kin", "bucket"])
              .withColumn("share", F.pmod(F.xxhash64("anchor"), "shares")).drop("shares"))
    return copies.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInPandas(run, schema)


def _from(anchors: DataFrame, lengths: DataFrame, first: int) -> DataFrame:
    """``anchors`` for every bucket from ``first`` on that can hold a score of ``reach``."""
    can = F.when(F.col("reach") <= 0, F.size("lengths")).otherwise(F.size(F.filter(
        "lengths", lambda x: x * F.col("length") * (1 + _SLACK) >= F.col("reach"))))
    buckets = F.when(can > first, F.sequence(F.lit(first).cast("long"), can.cast("long") - 1))
    return anchors.join(lengths, "kin").withColumn("bucket", F.explode(buckets)).drop("lengths")


def _best(found: DataFrame, by: list[str], score: str, name: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), name)
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def positives_of(rows: DataFrame, anchors: DataFrame, k: int, n: int) -> DataFrame:
    """``anchor, positive_id, positive_score, rank`` of each anchor's ``k`` best rows of its label."""
    kin = F.concat_ws(":", "dim", "label")
    dealt, lengths = _bucketed(rows, kin, n)
    schema = "anchor string, positive_id long, positive_score long"
    asking = anchors.withColumn("kin", kin)
    start = asking.withColumns({"bucket": F.lit(0).cast("long"), "reach": F.lit(ANY)})
    seeds = stored(_asked(dealt, start, _positives(k), schema), "seeds")
    # Fewer than k in the first bucket (of few rows) set no bound.
    bound = seeds.groupBy("anchor").agg(F.when(F.count(F.lit(1)) >= k, F.min("positive_score")).alias("reach"))
    asking = asking.join(bound, "anchor", "left").withColumn("reach", F.coalesce("reach", F.lit(ANY)))
    further = _from(asking, lengths, 1)
    found = seeds.unionByName(_asked(dealt, further, _positives(k), schema))
    return _best(found, ["anchor"], "positive_score", "positive_id", k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``: for each anchor (a row of ``vec_id, embedding, label`` with
    ``is_anchor``, a condition on ``vec_id``, ``label`` or ``vector``) and each of
    its first positives the first rows of other labels that score between
    ``low`` percent of the positive's score and all of it."""
    rows = stored(scaled(vectors), "scaled")
    n = rows.count()
    anchors = rows.filter(is_anchor).dropDuplicates(["vec_id", "label", "vector"])
    # Only rows of one id need the rest of the key.
    key = F.concat_ws(":", "vec_id", F.xxhash64("label", "vector"))
    anchors = stored(anchors.select(key.alias("anchor"), F.col("vec_id").alias("anchor_id"), "label", "vector", "dim",
                                    "length"), "anchors")
    found = stored(positives_of(rows, anchors, positives, n), "positives").filter("positive_score >= 0")
    # No whole score of any band is below this.
    bands = found.groupBy("anchor").agg(F.collect_set("positive_score").alias("bands"),
                                        F.expr(f"min(positive_score) * {low} div 100").alias("reach"))
    kin = F.col("dim").cast("string")
    dealt, lengths = _bucketed(rows, kin, n)
    questions = _from(anchors.withColumn("kin", kin).join(bands, "anchor"), lengths, 0)
    near = _best(_asked(dealt, questions, _negatives(negatives, low),
                        "anchor string, positive_score long, negative_id long, negative_score long"),
                 ["anchor", "positive_score"], "negative_score", "negative_id", negatives)
    return (found.select("anchor", "positive_id", "positive_score").join(near, ["anchor", "positive_score"])
            .join(anchors.select("anchor", "anchor_id"), "anchor")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score",
                    "negative_score"))


def shifted_sevenths(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding, label`` with the contract's label noise: one further where 7 divides the id."""
    label = F.col("label").cast("long")
    return vectors.select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10)
                          .otherwise(label).alias("label"))
