"""Exact deduplication with a cuckoo-filter index over live digests.

Every document gives the SHA-256 of its text after each run of white space
became one space.  Digests are dealt out by value; each task owns an index of
the digests it has seen so far:

* a cuckoo filter answers "surely new" or "maybe known";
* a hit is verified against the digests stored in the content bucket;
* an insertion that finds no free slot doubles the filter and refills it from
  the stored digests;
* a withdrawn digest is deleted from filter and content.

Copies are merged per Arrow batch before the shuffle, so a text that makes up
a third of the input sends one row per batch.  A task holds at most about
``ROWS_PER_TASK`` digests; the number of tasks follows the number of rows.
Digest order does not matter (minimum and sum), so a repeated task gives the
same rows.

Nulls count as empty texts; a null ``doc_id`` sorts after all ids.  Rows that
repeat id and text are copies of each other and exactly one of them stays.
An empty table gives an empty result.  Only ``doc_id`` and ``text`` are read,
so further columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import SPACE, numbered, parts_for, stored, text_or_empty, unused

_SLOTS = 4
_KICKS = 200
_LAST = (1 << 63) - 1


def _mixed(x: int) -> int:
    x = (x ^ (x >> 15)) * 0x2C1B3C6D & 0xFFFFFFFF
    return (x ^ (x >> 12)) * 0x297A2D39 & 0xFFFFFFFF


class CuckooFilter:
    """Partial-key cuckoo filter: four 32-bit fingerprints in a bucket, two
    candidate buckets for each key, so keys can also be deleted."""

    def __init__(self, buckets: int = 1024):
        if buckets & (buckets - 1):
            raise ValueError("buckets must be a power of two")
        self.mask = buckets - 1
        self.table = [[] for _ in range(buckets)]
        self._turn = 0

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[:4], "little")
        home = int.from_bytes(digest[8:16], "little") & self.mask
        return mark, home, (home ^ _mixed(mark)) & self.mask

    def __contains__(self, digest: bytes) -> bool:
        mark, a, b = self._places(digest)
        return mark in self.table[a] or mark in self.table[b]

    def insert(self, digest: bytes) -> bool:
        """False when no slot could be freed; the filter must then be rebuilt."""
        mark, a, b = self._places(digest)
        for place in (a, b):
            if len(self.table[place]) < _SLOTS:
                self.table[place].append(mark)
                return True
        place = b
        for _ in range(_KICKS):
            self._turn = (self._turn + 1) % _SLOTS
            bucket = self.table[place]
            mark, bucket[self._turn] = bucket[self._turn], mark
            place = (place ^ _mixed(mark)) & self.mask
            if len(self.table[place]) < _SLOTS:
                self.table[place].append(mark)
                return True
        return False

    def delete(self, digest: bytes) -> bool:
        mark, a, b = self._places(digest)
        for place in (a, b):
            if mark in self.table[place]:
                self.table[place].remove(mark)
                return True
        return False


class DigestIndex:
    """Live digests with, for each, the row that stays and the group size."""

    def __init__(self, buckets: int = 1024):
        self.filter = CuckooFilter(buckets)
        self.content: dict[int, list[list]] = {}
        self.resized = 0

    def _bucket(self, digest: bytes) -> list[list]:
        return self.content.setdefault(int.from_bytes(digest[16:20], "little"), [])

    def _resize(self) -> None:
        buckets = 2 * len(self.filter.table)
        while True:
            self.filter = CuckooFilter(buckets)
            self.resized += 1
            if all(self.filter.insert(e[0]) for es in self.content.values() for e in es):
                return
            buckets *= 2

    def add(self, digest: bytes, keeper: tuple, n: int) -> None:
        bucket = self._bucket(digest)
        if digest in self.filter:
            for entry in bucket:
                if entry[0] == digest:
                    entry[1] = min(entry[1], keeper)
                    entry[2] += n
                    return
        bucket.append([digest, keeper, n])
        if not self.filter.insert(digest):
            self._resize()

    def remove(self, digest: bytes) -> bool:
        if digest not in self.filter:
            return False
        bucket = self._bucket(digest)
        for i, entry in enumerate(bucket):
            if entry[0] == digest:
                del bucket[i]
                return self.filter.delete(digest)
        return False

    def __iter__(self) -> Iterator[list]:
        for bucket in self.content.values():
            yield from bucket


_EVENT = "digest binary, doc_id long, row_id long, n long"
_EVENT_ARROW = pa.schema([("digest", pa.binary()), ("doc_id", pa.int64()), ("row_id", pa.int64()), ("n", pa.int64())])


def _merge_batches(batches):
    """One event for each digest of a batch: its first row and the number of rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        digests = np.array(batch.column("digest").to_pylist(), dtype="S64")
        ids = batch.column("doc_id").fill_null(_LAST).to_numpy(zero_copy_only=False)
        rows = batch.column("row_id").to_numpy(zero_copy_only=False)
        order = np.lexsort((rows, ids, digests))
        digests, ids, rows = digests[order], ids[order], rows[order]
        first = np.flatnonzero(np.r_[True, digests[1:] != digests[:-1]])
        n = np.diff(np.r_[first, len(digests)])
        yield pa.record_batch([pa.array([bytes.fromhex(d.decode()) for d in digests[first]], pa.binary()),
                               pa.array(ids[first]), pa.array(rows[first]), pa.array(n.astype("int64"))],
                              schema=_EVENT_ARROW)


def _index_partition(batches):
    index, withdrawn = DigestIndex(), []
    for batch in batches:
        for digest, doc, row, n in zip(*(batch.column(c).to_pylist() for c in ("digest", "doc_id", "row_id", "n")),
                                       strict=True):
            if n:
                index.add(digest, (doc, row), n)
            else:
                withdrawn.append(digest)
    for digest in withdrawn:
        index.remove(digest)
    rows, out = iter(index), []
    for entry in rows:
        out.append(entry)
        if len(out) == 20_000:
            yield _groups(out)
            out = []
    yield _groups(out)


def _groups(entries):
    return pa.record_batch([pa.array([e[0] for e in entries], pa.binary()),
                            pa.array([None if e[1][0] == _LAST else e[1][0] for e in entries], pa.int64()),
                            pa.array([e[1][1] for e in entries], pa.int64()),
                            pa.array([e[2] for e in entries], pa.int64())],
                           names=["digest", "keep_id", "keep_row", "group_size"])


def text_digest(text):
    return F.sha2(F.regexp_replace(text, SPACE, " "), 256)


def exact_dedup(docs: DataFrame, withdrawn: DataFrame | None = None, row: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``row_id, doc_id, keep_id, group_size,
    kept, text_sha256``.

    ``row_id`` is the column ``row`` of a ``numbered`` table, or else a number that
    only this result knows.  ``withdrawn``
    (column ``text_sha256``) names texts that are deleted from the index: their
    rows come back with ``kept`` false and no ``keep_id``.
    """
    rows = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                              (F.col(row) if row else F.monotonically_increasing_id()).alias("row_id"),
                              text_digest(text_or_empty()).alias("digest")), "digests")
    events = rows.mapInArrow(_merge_batches, _EVENT)
    if withdrawn is not None:
        events = events.unionByName(withdrawn.select(
            F.unhex("text_sha256").alias("digest"), F.lit(None).cast("long").alias("doc_id"),
            F.lit(None).cast("long").alias("row_id"), F.lit(0).cast("long").alias("n")))
    groups = (events.repartition(parts_for(rows.count()), "digest")
              .mapInArrow(_index_partition, "digest binary, keep_id long, keep_row long, group_size long"))
    groups = groups.withColumn("digest", F.lower(F.hex("digest")))
    return (rows.join(groups, "digest", "left" if withdrawn is not None else "inner")
            .select("row_id", "doc_id", "keep_id", "group_size",
                    (F.col("row_id").eqNullSafe(F.col("keep_row"))).alias("kept"),
                    F.col("digest").alias("text_sha256")))


def keep_first_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without later copies, all columns kept."""
    row, = unused(docs, "__row")
    marked = numbered(docs, row)
    kept = exact_dedup(marked, row=row).filter("kept").select(F.col("row_id").alias(row))
    return marked.join(kept, row, "left_semi").drop(row)
