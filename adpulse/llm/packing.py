"""Harmonic packing of tokenised documents into sequences of fixed capacity.

Every document is tokenised, closed with an end token, and cut into pieces.
Whole sequences are cut off first; the rest is cut into slots of the harmonic
classes: a piece of class k lies in a slot of ``capacity // k`` tokens, and
every sequence of the class holds exactly k of them.  A piece is given the
smallest slot that fits if that leaves little of the slot empty; otherwise the
largest slot that it fills wholly is cut off, and the rest is classed again.
Pieces shorter than 64 tokens are cut into powers of two, whose slots divide
the capacity.  So padding is bounded by the share a slot may leave empty.

Workers class their documents independently: a piece's number inside (worker,
class) is counted while tokenising, and the prefix sums of the workers' counts,
a table of one row per worker and class, turn it into its number in the class.
Sequence ``number // k`` and place ``number % k`` need no further exchange.
The last sequence of each class may be short of pieces; these remainders (less
than k pieces of each class, at most about 5000 in all, whatever the input)
are packed together, longest first.

Null texts count as empty: the document is the end token alone.  Repeated rows
are packed once each.  Empty tables give empty results.  Only ``doc_id`` and
``text`` are read.  The pieces are stored before they are numbered, so a
worker that is lost cannot change numbers that others already use.
"""

from __future__ import annotations

import array
import bisect
import functools
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adpulse.llm.common import stored

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: A slot may stay empty to one part in so many.
SPARE = 64
#: Shorter pieces are cut into powers of two.
SMALL = 64
#: Bytes of words and ids that a worker remembers, in each of two generations.
REMEMBERED = 128 << 20
#: About what one remembered word takes, besides its letters and ids.
_ENTRY_BYTES = 200
#: Texts that are tokenised together.
SLICE_BYTES = 16 << 20

_PLAIN = re.compile(r"([^\W\d_]+)([!-/:-@\[-`{-~]*)").fullmatch


def _byte_letters() -> dict[int, int]:
    """The character that stands for each byte in byte-level vocabularies: printable
    Latin-1 characters stand for themselves, the others for those from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in own)
    return {b: 256 + n for n, b in enumerate(others)}


class WordTokenizer:
    """Ids of a word-level BPE tokenizer as little-endian 32-bit numbers.

    The tokenizer splits at white space before anything else, so a text's ids
    are those of its words one after the other.  The different words of a slice
    of texts are looked up once and gathered by index; words are remembered in
    two generations of about ``remembered`` bytes, so common ones stay."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.remembered, self.held = remembered, 0
        self.known: dict[str, bytes] = {}
        self.old = self.known
        self.marks = functools.lru_cache(10_000)(self._piece)

    def _piece(self, piece: str) -> bytes:
        return array.array("I", [t.id for t in self.tokenizer.model.tokenize(piece)]).tobytes()

    def _word(self, word: str) -> bytes:
        """Letters with ASCII marks after them are two pieces; all other words take the tokenizer's own steps."""
        if not word:
            return b""
        if plain := _PLAIN(word):
            letters, marks = plain.groups()
            low = letters.lower()
            if low.isascii():
                return self._piece(low) + self.marks(marks) if marks else self._piece(low)
            if low.isalpha() and "\u03a3" not in letters and unicodedata.is_normalized("NFC", letters):
                low = low.encode().decode("latin-1").translate(self.letters)
                return self._piece(low) + self.marks(marks) if marks else self._piece(low)
        t = self.tokenizer
        if "<|" in word:
            return array.array("I", t.encode(word, add_special_tokens=False).ids).tobytes()
        return b"".join([self._piece(p) for p, _ in
                         t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(word))])

    def _learn(self, words: list[str]) -> None:
        if self.held > self.remembered:
            self.old, self.known, self.held = self.known, {}, 0
        known, old, held = self.known, self.old, 0
        for word in words:
            if word not in known:
                ids = old.get(word)
                known[word] = ids = self._word(word) if ids is None else ids
                held += 4 * len(word) + len(ids) + _ENTRY_BYTES
        self.held += held

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: none) one after the other, and the bounds of each text's ids among them."""
        words = pc.split_pattern(pc.replace_substring(texts.fill_null(""), "\n", " "), " ")
        coded = words.values.dictionary_encode()
        different = coded.dictionary.to_pylist()
        self._learn(different)
        found = list(map(self.known.__getitem__, different))
        joined = np.frombuffer(b"".join(found), "<u4")
        n = np.fromiter(map(len, found), np.int64, len(found)) // 4
        at = coded.indices.to_numpy()
        own = n[at]
        upto = np.concatenate(([0], np.cumsum(own)))
        kind = np.int32 if upto[-1] < 1 << 31 else np.int64
        gather = np.repeat(((np.cumsum(n) - n)[at] - upto[:-1]).astype(kind), own)
        gather += np.arange(upto[-1], dtype=kind)
        return joined[gather], upto[words.offsets.to_numpy()]


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``SLICE_BYTES``; a longer text is a run of its own."""
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    begin = held = 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > SLICE_BYTES:
            yield begin, i
            begin, held = i, 0
        held += size
    if begin < len(sizes):
        yield begin, len(sizes)


def slot_classes(capacity: int = CAPACITY) -> list[int]:
    """The k of all classes: 1, 2, 3, ... down to slots of ``SMALL``, then powers of two."""
    ks = list(range(1, max(1, capacity // SMALL) + 1))
    k = 1
    while k < ks[-1]:
        k *= 2
    while k <= capacity:
        if k > ks[-1]:
            ks.append(k)
        k *= 2
    return ks


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(piece length, class) of a document of ``length`` ids, in order."""
    pieces = [(capacity, 1)] * (length // capacity)
    rest = length % capacity
    while rest >= SMALL:
        k = capacity // rest
        slot = capacity // k
        if (slot - rest) * SPARE <= slot:
            pieces.append((rest, k))
            return pieces
        k += 1
        slot = capacity // k
        if slot < SMALL:
            break
        pieces.append((slot, k))
        rest -= slot
    while rest:
        slot = 1 << (rest.bit_length() - 1)
        pieces.append((slot, capacity // slot))
        rest -= slot
    return pieces


_PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
           "class int, worker int, number long")
_TOKENIZERS: dict[str, WordTokenizer] = {}


def _pieces_of(tokenizer_file: str, capacity: int):
    def run(batches):
        import public_tokenizers

        path = public_tokenizers.path(tokenizer_file) if "/" not in tokenizer_file else tokenizer_file
        tokenizer = _TOKENIZERS.get(path)
        if tokenizer is None:
            tokenizer = _TOKENIZERS[path] = WordTokenizer(path)
        worker, counts = TaskContext.get().partitionId(), {}
        end = END_ID.to_bytes(4, "little")
        names = [f.split()[0] for f in _PIECES.split(", ")]
        for batch in batches:
            cols = [[] for _ in names]
            for begin, to in _slices(batch.column("text")):
                ids, bounds = tokenizer.ids(batch.column("text")[begin:to])
                ids, bounds = memoryview(ids).cast("B"), bounds.tolist()
                for doc, first, last in zip(batch.column("doc_id")[begin:to].to_pylist(), bounds, bounds[1:], strict=False):
                    n, start = last - first + 1, 0
                    for length, k in cut(n, capacity):
                        number = counts.get(k, 0)
                        counts[k] = number + 1
                        crc = zlib.crc32(ids[4 * (first + start):4 * min(first + start + length, last)])
                        start += length
                        if start == n:
                            crc = zlib.crc32(end, crc)
                        for col, v in zip(cols, (doc, start - length, length, crc, n, k, worker, number), strict=True):
                            col.append(v)
            types = {"class": pa.int32(), "worker": pa.int32()}
            yield pa.record_batch([pa.array(c, types.get(n, pa.int64())) for n, c in zip(names, cols, strict=True)],
                                  names=names)
    return run


def _pack_rest(capacity: int):
    def run(pdf):
        """First fit, longest first; the group holds the classes' remainders only."""
        pdf = pdf.sort_values(["length", "class", "number"], ascending=[False, True, True])
        free, seqs, offsets = [], [], []  # free: sorted (space, sequence)
        made = 0
        for length in pdf["length"]:
            i = bisect.bisect_left(free, (length, -1))
            if i == len(free):
                space, seq = capacity, made
                made += 1
            else:
                space, seq = free.pop(i)
            seqs.append(seq)
            offsets.append(capacity - space)
            if space > length:
                bisect.insort(free, (space - length, seq))
        return pdf.assign(sequence_id=seqs, offset=offsets)[[*_OUT]]
    return run


_OUT = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``.

    Sequences of class ``classes[i]`` have ids ``bin * len(classes) + i + 1``
    shifted by the remainders' ids, which are the multiples of ``len(classes) + 1``.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    classes = slot_classes(capacity)
    pieces = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                    .mapInArrow(_pieces_of(tokenizer, capacity), _PIECES), "pieces")
    counts = pieces.groupBy("worker", "class").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumns({
        "first": F.sum("n").over(Window.partitionBy("class").orderBy("worker")) - F.col("n"),
        "all": F.sum("n").over(Window.partitionBy("class"))})
    counts = counts.select(F.col("worker").alias("__w"), F.col("class").alias("__k"), "first", "all")
    placed = (pieces.join(counts, (F.col("worker") == F.col("__w")) & (F.col("class") == F.col("__k")))
              .withColumn("number", F.col("first") + F.col("number"))
              .withColumn("whole", F.col("number") < F.expr("all - all % class")))
    at = F.array_position(F.array(*map(F.lit, classes)), F.col("class"))
    kinds = len(classes) + 1
    inside = Window.partitionBy("sequence_id").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    full = (placed.filter("whole")
            .withColumn("sequence_id", (F.expr("number div class") * kinds + at).cast("long"))
            .withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long")))
    rest_schema = ", ".join(f"{c} long" for c in _OUT)
    rest = (placed.filter("not whole").withColumn("__all", F.lit(0)).groupBy("__all").applyInPandas(_pack_rest(capacity), rest_schema)
            .withColumn("sequence_id", F.col("sequence_id") * kinds))
    return full.select(*_OUT).unionByName(rest.select(*_OUT))
