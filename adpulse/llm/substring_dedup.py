"""Removal of passages that an earlier document already has, by seed and extend.

* Seed: each document gives the winnowed anchors of its text: of every window
  of ``window`` words, the five-word gram with the smallest hash.  Equal
  windows have the same anchor at the same place, so a window that repeats
  must have an anchor that occurs at least twice.  Documents are joined on
  such anchors; everything else leaves here.
  Counting comes first and is cheap: workers send the distinct keys of their
  anchors in buckets, as packed 32-bit numbers, and a bucket's owner names those
  seen twice.  Keys are cut to 32 bits beyond the bucket's own, whose number
  follows the corpus, so a chance match is rare and only costs a comparison.
* Extend: around each joined anchor the match reaches as far to the left and to
  the right as the windows that chose the anchor: each is compared as a whole
  (64-bit hash of its words) with the smallest document that has it.
* Keep maximal repeats: overlapping windows that match run together into
  maximal repeats of at least ``window`` words, whose words are removed.

Documents with the words of a smaller document are copies as a whole: they lose
all words and need no windows, nor do the windows of others need theirs.

Only windows that start in a document with a smaller ``doc_id`` count, judged
on the input.  Anchors and windows are counted by aggregates that combine
before the shuffle and then joined back, so a passage that a third of the
documents share costs rows in proportion to its occurrences, never pairs, and
a hot value can be split over tasks.  Texts are shuffled once; all uses ask for
the same columns, so they share the exchange.

Null texts have no words; a null ``doc_id`` is smaller than none and loses
nothing.  Rows with one id do not count as earlier for each other.  Texts of
fewer than ``window`` words stay whole.  Empty tables give empty results.  Only
``doc_id`` and ``text`` are read.

Rows are known by a hash of id and text, which every scan computes alike; rows that
share both have the same result.  Should two rows share the hash alone, the anchors of
one are looked at in the other as well, and all decisions also ask for the same id.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import SPACE, parts_for, stored, text_or_empty
from adpulse.llm.wordhash import Words, grams

WINDOW = 13
SEED_WORDS = 5
#: Anchor keys that a worker packs at once, and that a bucket should hold; a guess of a text's anchors.
_HELD_KEYS = 1_000_000
_ANCHORS_PER_TEXT = 128


def _chosen(h: np.ndarray, window: int, seed: int) -> np.ndarray:
    """The start of the anchor of each window of ``window`` words of one text."""
    x = grams(h, seed)
    span = window - seed + 1
    if len(x) < span:
        return np.zeros(0, np.int64)
    places = np.lib.stride_tricks.sliding_window_view(x, span)
    return places.argmin(1) + np.arange(len(places))


def _chunks(batch, size: int = 4 << 20):
    """Slices of a batch of at most ``size`` bytes of text (or one row)."""
    lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
    at = 0
    while at < len(lengths):
        to, total = at + 1, lengths[at]
        while to < len(lengths) and total + lengths[to] <= size:
            total += lengths[to]
            to += 1
        yield batch.slice(at, to - at)
        at = to


def _texts_anchors(batch, window: int, seed: int, bits: int):
    """(row, anchor keys of ``bits`` bits, their places) of every text of a batch that has any."""
    words = Words(batch.column("text").to_pylist())
    for row, doc, a, b in zip(*(batch.column(c).to_pylist() for c in ("row_id", "doc_id")),
                              words.first[:-1], words.first[1:], strict=True):
        if doc is not None:
            h = words.hash[a:b]
            at = np.unique(_chosen(h, window, seed))
            if len(at):
                yield row, grams(h, seed)[at] >> np.uint64(64 - bits), at


def _packed_keys(window: int, seed: int, bits: int):
    """Distinct keys in buckets: those a worker saw once and those it saw more often."""
    def packed(keys):
        keys, n = np.unique(np.concatenate(keys), return_counts=True)
        bucket, first = np.unique(keys >> np.uint64(32), return_index=True)
        low = (keys & np.uint64(0xFFFFFFFF)).astype("<u4")
        parts = list(zip(np.split(low, first[1:]), np.split(n, first[1:]), strict=True))
        return pa.record_batch([pa.array(bucket.astype(np.int64)), pa.array([x[c == 1].tobytes() for x, c in parts]),
                                pa.array([x[c > 1].tobytes() for x, c in parts])], names=["bucket", "once", "more"])

    def run(batches):
        held, n = [], 0
        for whole in batches:
            for batch in _chunks(whole):
                for _, keys, _ in _texts_anchors(batch, window, seed, bits):
                    held.append(keys)
                    n += len(keys)
                if n >= _HELD_KEYS:
                    yield packed(held)
                    held, n = [], 0
        if held:
            yield packed(held)
    return run


def _repeated_keys(batches):
    """Keys of a bucket that two workers' lists, or one worker's texts, have twice; buckets arrive one after the other."""
    def repeated(bucket, once, more):
        keys, n = np.unique(np.frombuffer(b"".join(once), "<u4"), return_counts=True)
        keys = np.union1d(keys[n > 1], np.intersect1d(keys, more := np.frombuffer(b"".join(more), "<u4")))
        keys = np.union1d(keys, more).astype(np.uint64) | np.uint64(bucket << 32)
        return pa.record_batch([pa.array(keys.view(np.int64))], names=["anchor"])
    current, once, more = None, [], []
    for batch in batches:
        for bucket, o, m in zip(*(batch.column(c).to_pylist() for c in ("bucket", "once", "more")), strict=True):
            if bucket != current:
                if current is not None:
                    yield repeated(current, once, more)
                current, once, more = bucket, [], []
            once.append(o)
            more.append(m)
    if current is not None:
        yield repeated(current, once, more)


def _anchors(window: int, seed: int, bits: int):
    def run(batches):
        for whole in batches:
            for batch in _chunks(whole):
                out = [(keys.view(np.int64), np.full(len(at), row), at.astype(np.int32))
                       for row, keys, at in _texts_anchors(batch, window, seed, bits)]
                if out:
                    yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)],
                                          names=["anchor", "row_id", "at"])
    return run


def _windows(window: int, seed: int):
    def run(batches):
        for whole in batches:
            for batch in _chunks(whole):
                words = Words(batch.column("text").to_pylist())
                out = []
                for row, doc, hits, a, b in zip(*(batch.column(c).to_pylist() for c in ("row_id", "doc_id", "hits")),
                                                words.first[:-1], words.first[1:], strict=True):
                    h = words.hash[a:b]
                    hit = np.zeros(b - a, bool)
                    hits = np.array(hits, np.int64)
                    hit[hits[hits < len(hit)]] = True
                    start = np.flatnonzero(hit[_chosen(h, window, seed)])
                    out.append((grams(h, window)[start].view(np.int64), np.full(len(start), row),
                                np.full(len(start), doc), start.astype(np.int32)))
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)],
                                      names=["passage", "row_id", "doc_id", "start"])
    return run


def _removed(window: int):
    def run(batches):
        for batch in batches:
            out = []
            for doc, text, copy, starts in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "copy", "starts")),
                                               strict=True):
                words = (text or "").encode("utf-8", "replace").split()
                n, gone = len(words), 0
                if copy and n >= window:
                    words, gone = [], n
                elif starts:
                    edge = np.zeros(n + 1, np.int64)
                    at = np.array(starts)
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + window, -1)
                    stay = np.cumsum(edge[:n]) == 0
                    gone = n - int(stay.sum())
                    words = [words[i] for i in np.flatnonzero(stay)]
                kept = b" ".join(words)
                out.append((doc, n, gone, hashlib.sha256(kept).hexdigest(), kept.decode()))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 5, (
                pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])
    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED_WORDS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept`` (the words left, joined by a space)."""
    if not 1 <= seed <= window:
        raise ValueError("seed must be between 1 and window")
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    texts = docs.select(F.xxhash64(doc_id, text).alias("row_id"), doc_id.alias("doc_id"), text.alias("text"))
    words = F.trim(F.regexp_replace(text_or_empty(), SPACE, " "))
    same = stored(texts.select("row_id", "doc_id", F.sha2(words, 256).alias("words")), "words")
    smallest = same.groupBy("words").agg(F.min("doc_id").alias("smallest"))
    copies = stored(same.join(smallest, "words").filter("smallest < doc_id")
                    .select("row_id", F.col("doc_id").alias("of")).distinct(), "copies")

    def same_id(other: DataFrame):
        # As a difference, so that texts are dealt out by row_id alone and all joins share that.
        return (texts["row_id"] == other["row_id"]) & (texts["doc_id"] - other["of"] == 0)
    # The stored table's size decides whether it is sent to the texts or these are dealt out.
    first_copies = texts.join(copies, same_id(copies), "left_anti").select("row_id", "doc_id", "text")
    bits = 32 + max(10, (parts_for(same.count() * _ANCHORS_PER_TEXT, _HELD_KEYS) - 1).bit_length())
    seeds = (first_copies.mapInArrow(_packed_keys(window, seed, bits), "bucket long, once binary, more binary")
             .repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_repeated_keys, "anchor long"))
    anchors = first_copies.mapInArrow(_anchors(window, seed, bits), "anchor long, row_id long, at int")
    hits = anchors.join(seeds, "anchor").groupBy("row_id").agg(F.collect_list("at").alias("hits"))
    passages = (texts.join(hits, "row_id").select("row_id", "doc_id", "text", "hits")
                .mapInArrow(_windows(window, seed), "passage long, row_id long, doc_id long, start int"))
    first = passages.groupBy("passage").agg(F.min("doc_id").alias("first"))
    covered = (passages.join(first, "passage").filter("first < doc_id")
               .groupBy("row_id", F.col("doc_id").alias("of")).agg(F.collect_list("start").alias("starts")))
    fate = covered.unionByName(copies.withColumn("starts", F.lit(None).cast("array<int>")))
    fate = fate.withColumn("copy", F.col("starts").isNull())
    return (texts.join(fate, same_id(fate), "left")
            .select("doc_id", "text", "copy", "starts")
            .mapInArrow(_removed(window), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"))
