"""Token ids in binary files with a minimal perfect hash index.

Documents are tokenised, closed with an end id and dealt out in ascending order of
``doc_id``.  One task writes one shard:

    shard-00000.ids   the ids of its documents one after the other, little-endian
                      unsigned numbers of 16 bits (32 if the vocabulary is larger)
                      and nothing else
    shard-00000.dir   one fixed-size record (``ENTRY``) for each document: id, first
                      id in the shard, number of ids
    index-00000.mph   minimal perfect hash of a share of the keys (by hash), with a
                      fingerprint, the shard and the directory entry of each key
    manifest, layout  tables: a row for each shard (entries, ids, ids before it); number
                      of index files and the shard of documents without an id

To find a document, its key's hash names the index file and the slot in it, the
stored fingerprint tells foreign keys, and the slot names the shard and the
entry: a constant number of steps and two short reads, however many documents.
``lookup`` does this for a table of keys, ``Reader`` for one key.

The hash is built in levels: keys that are alone on their bit of a level's array
are placed there, the others go to the next level; a key's slot is the number
of set bits before its own.  So n keys take the slots 0 to n - 1.

The folder must be one that ``pyarrow.fs`` opens (a shared path, hdfs, s3, gs).
Files are written to a hidden name and then renamed, so a task that runs twice
leaves one file; both attempts write the same, as rows are sorted first.  A shard
has about ``SHARD_BYTES`` of text, an index file about ``KEYS`` keys.

Texts are cut before single line ends and before spaces that other characters follow;
the tokenizer never joins across such a place, so its ids for the pieces are those for
the whole.  Each different piece is encoded once and remembered, in two generations of
about ``REMEMBERED`` bytes.  Texts with other white space are encoded as a whole,
or in long slices.

Nulls: a null text counts as empty (the end id alone); rows with a null id come
first; the layout table names their shard, so they need no key.  Rows with the same id follow each other, by
text, and share a key; a lookup gives all of them.  An empty table gives a
manifest without shards and no documents.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import array
import functools
import os
import re
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adpulse.llm.common import parts_for, stored
from adpulse.llm.packing import _byte_letters
from adpulse.sources.sinks import scratch_path

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
SHARD_BYTES = 32 << 20
KEYS = 200_000
REMEMBERED = 128 << 20
#: About what one remembered piece takes, besides its letters.
_ENTRY_BYTES = 200
#: Letters with ASCII marks after them (no apostrophe, which may join them), perhaps after a line end.
_SIMPLE = re.compile(r"(\n?)([^\W\d_]+)([!-&(-/:-@\[-`{-~]*)").fullmatch
#: Characters of a slice of a text that is encoded as a whole, and a place to cut.
_SLICE = 1 << 20
_CUT = re.compile(r"\S \S").search
ENTRY = np.dtype([("doc_id", "<i8"), ("no_id", "<i8"), ("first", "<i8"), ("n", "<i8")])
SLOT = np.dtype([("mark", "<u4"), ("shard", "<u4"), ("entry", "<u8")])
#: Bits of a level for each key that is left, and levels before the rest is listed.
GAMMA, MOST_LEVELS = 2, 40


class PieceTokenizer:
    """Ids of texts as arrays of ``kind``, in bytes."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.remembered, self.held = remembered, 0
        self.known: dict[str, bytes | None] = {}
        self.old = self.known
        self.letters = _byte_letters()
        self.marks = functools.lru_cache(10_000)(lambda marks: self.encoded([marks])[0])

    def _bytes(self, ids: list[int]) -> bytes:
        return array.array(self.kind, ids).tobytes()

    def encoded(self, texts: list[str]) -> list[bytes]:
        """Each text as a whole."""
        return [self._bytes(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> None:
        """Ids of pieces; None for those of which this cannot be said without what is around them."""
        known, old, model, others = self.known, self.old, self.tokenizer.model, []
        for p in new:
            if p in old:
                known[p] = old[p]
            elif m := _SIMPLE(p):
                line, letters, marks = m.groups()
                # The vocabulary writes bytes as letters: a space as this one, ASCII letters as they are.
                if not letters.isascii():
                    letters = letters.encode().decode("latin-1").translate(self.letters)
                ids = self._bytes([t.id for t in model.tokenize(letters if line else "\u0120" + letters)])
                if line:
                    ids = self.marks(line) + ids
                known[p] = ids + self.marks(marks) if marks else ids
            elif p == "\n" or (line := p.removeprefix("\n")) and not line[0].isspace() and not line[-1].isspace():
                others.append(p)
            else:
                known[p] = None
        known.update(zip(others, self.encoded([p if p[0] == "\n" else " " + p for p in others]), strict=True))
        self.held += sum(map(len, new)) * 3 + _ENTRY_BYTES * len(new)

    def ids(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text of a column (null: empty)."""
        if not len(texts):
            return []
        texts = texts.fill_null("")
        apart = pc.ends_with(texts, "\n\n")
        for x in ("\n\n\n", "\n\n ", *self.special):
            apart = pc.or_(apart, pc.match_substring(texts, x))
        pieces = pc.split_pattern(pc.replace_substring(pc.if_else(apart, "", texts), "\n", " \n"), " ")
        first = pieces.offsets.to_numpy()
        coded = pieces.values.dictionary_encode()
        at, words = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        if self.held > self.remembered:  # what is asked for again comes back from the generation before
            self.old, self.known, self.held = self.known, {}, 0
        follows = np.ones(len(at), bool)
        follows[first[:-1]] = False  # a text's first piece has no space before it
        self._learn([w for w in words if w not in self.known])
        found = list(map(self.known.__getitem__, words))
        whole = apart.to_numpy(zero_copy_only=False)
        if None in found:
            unsaid = np.array([ids is None for ids in found])
            found = [ids or b"" for ids in found]
            whole = whole | np.logical_or.reduceat(unsaid[at] & follows, first[:-1])
        joined = np.frombuffer(b"".join(found), self.kind)
        n = np.fromiter(map(len, found), np.int32, len(found)) // joined.itemsize
        start, own = (np.cumsum(n, dtype=np.int32) - n)[at], n[at] * follows
        upto = np.cumsum(own)
        body = joined[np.repeat(start - (upto - own).astype(np.int32), own) + np.arange(upto[-1], dtype=np.int32)].tobytes()
        ends = np.concatenate(([0], upto))[first] * joined.itemsize
        begin = self.encoded([words[i] for i in at[first[:-1]]])
        out = [b + body[x:y] for b, x, y in zip(begin, ends[:-1], ends[1:], strict=True)]
        for i in np.flatnonzero(whole):
            out[i] = self._long(texts[int(i)].as_py())
        return out

    def _long(self, text: str) -> bytes:
        """A text as a whole, or in slices cut before a space between two that are none, unless it holds a special token."""
        if len(text) <= _SLICE or any(s in text for s in self.special):
            return self.encoded([text])[0]
        out, at = [], 0
        while at < len(text):
            cut = _CUT(text, at + _SLICE)
            to = cut.start() + 1 if cut else len(text)
            out += self.encoded([text[at:to]])
            at = to
        return b"".join(out)


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = x ^ np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: a slot from 0 to n - 1 for
    each of them, and some slot or none (-1) for all other keys."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest
        self.before = np.cumsum([0] + [int(level.sum()) for level in levels])
        self.ranks = [np.cumsum(level) - level for level in levels]

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        while len(left) and len(levels) < MOST_LEVELS:
            size = max(64, GAMMA * len(left))
            at = (_mix(left, len(levels) + 1) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone.astype(np.uint8))
            left = left[~alone[at]]
        return cls(levels, np.sort(left))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for i, level in enumerate(self.levels):
            at = (_mix(keys[left], i + 1) % np.uint64(len(level))).astype(np.int64)
            here = level[at] == 1
            out[left[here]] = self.before[i] + self.ranks[i][at[here]]
            left = left[~here]
        if len(self.rest):
            place = np.minimum(self.rest.searchsorted(keys[left]), len(self.rest) - 1)
            here = self.rest[place] == keys[left]
            out[left[here]] = self.before[-1] + place[here]
        return out

    def to_bytes(self) -> bytes:
        """Number of levels and of listed keys, sizes of the levels, their bits, the listed keys."""
        sizes = np.array([len(self.levels), len(self.rest), *map(len, self.levels)], "<u8")
        bits = b"".join(np.packbits(level, bitorder="little").tobytes() for level in self.levels)
        return sizes.tobytes() + bits + self.rest.astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> tuple[PerfectHash, int]:
        """The hash and the number of bytes that it took."""
        n, listed = np.frombuffer(data, "<u8", 2).astype(int)
        sizes, at, levels = np.frombuffer(data, "<u8", n, 16).astype(int), 16 + 8 * n, []
        for size in sizes:
            packed = np.frombuffer(data, np.uint8, -(-size // 8), at)
            levels.append(np.unpackbits(packed, count=size, bitorder="little"))
            at += len(packed)
        return cls(levels, np.frombuffer(data, "<u8", listed, at)), int(at + 8 * listed)


def _key(doc_id: np.ndarray) -> np.ndarray:
    """64-bit keys; mixing is one-to-one, so different ids have different keys."""
    return _mix(doc_id.astype(np.int64).view(np.uint64), 0x5EED)


def _share(key: np.ndarray, shares: int) -> np.ndarray:
    return (_mix(key, 0xF11E) % np.uint64(shares)).astype(np.int64)


def _mark(key: np.ndarray) -> np.ndarray:
    return (_mix(key, 0xF1) >> np.uint64(32)).astype("<u4")


def _opened(path: str) -> tuple[arrow_fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return arrow_fs.FileSystem.from_uri(path)


class _Written:
    """A file that appears under its name once it is complete."""

    def __init__(self, path: str):
        self.fs, self.path = _opened(path)
        folder, name = self.path.rsplit("/", 1)
        self.fs.create_dir(folder, recursive=True)
        self.hidden = f"{folder}/_{uuid.uuid4().hex}-{name}"
        self.out = self.fs.open_output_stream(self.hidden)

    def __enter__(self):
        return self.out

    def __exit__(self, kind, *_):
        self.out.close()
        if kind is None:
            try:
                self.fs.move(self.hidden, self.path)
                return
            except OSError:  # some file systems do not replace a file; then another attempt has written it
                if self.fs.get_file_info(self.path).type == arrow_fs.FileType.NotFound:
                    raise
        self.fs.delete_file(self.hidden)


def _read(path: str, first: int = 0, n: int | None = None) -> bytes:
    fs, path = _opened(path)
    with fs.open_input_file(path) as f:
        return f.read_at(f.size() - first if n is None else n, first)


def _slices(batch: pa.RecordBatch, size: int = 4 << 20):
    """(ids, texts) of a batch, about ``size`` bytes of text at a time."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy())
    cuts = np.unique(np.searchsorted(upto, np.arange(size, upto[-1], size)) + 1) if len(upto) else []
    for a, b in zip([0, *cuts], [*cuts, len(upto)], strict=True):
        yield batch.column("doc_id")[a:b].to_pylist(), batch.column("text")[a:b]


_DIRECTORY = "shard long, entry long, doc_id long, first long, n long, leads boolean"
_TOKENIZERS: dict[str, PieceTokenizer] = {}


def _file(tokenizer: str) -> str:
    import public_tokenizers

    return tokenizer if "/" in tokenizer else public_tokenizers.path(tokenizer)


def _kind(tokenizer: str) -> str:
    """The type of the ids in the files."""
    return {"H": "<u2", "I": "<u4"}[PieceTokenizer(_file(tokenizer)).kind]


def _shard_writer(path: str, tokenizer_file: str, end_id: int):
    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        file = _file(tokenizer_file)
        if file not in _TOKENIZERS:
            _TOKENIZERS[file] = PieceTokenizer(file)
        tokenizer, shard = _TOKENIZERS[file], TaskContext.get().partitionId()
        end, width = array.array(tokenizer.kind, [end_id]).tobytes(), array.array(tokenizer.kind).itemsize
        docs, sizes, at, payload = [], [], 0, None
        for batch in batches:
            for ids, texts in _slices(batch):
                if payload is None:
                    payload = _Written(f"{path}/shard-{shard:05d}.ids")
                out = payload.__enter__()
                for found in tokenizer.ids(texts):
                    out.write(found + end)
                    sizes.append(len(found) // width + 1)
                docs += ids
        if payload is None:
            return
        payload.__exit__(None, None, None)
        n = np.array(sizes, np.int64)
        first = np.cumsum(n) - n
        entries = np.zeros(len(docs), ENTRY)
        entries["doc_id"] = [0 if d is None else d for d in docs]
        entries["no_id"] = [d is None for d in docs]
        entries["first"], entries["n"] = first, n
        with _Written(f"{path}/shard-{shard:05d}.dir") as out:
            out.write(entries.tobytes())
        same = (entries["doc_id"][1:] == entries["doc_id"][:-1]) & (entries["no_id"][1:] == entries["no_id"][:-1])
        for at in range(0, len(docs), 10_000):
            some = slice(at, at + 10_000)
            yield pa.record_batch([pa.array(np.full(len(docs[some]), shard)), pa.array(np.arange(len(docs))[some]),
                                   pa.array(docs[some], pa.int64()), pa.array(first[some]), pa.array(n[some]),
                                   pa.array(np.concatenate(([True], ~same))[some])],
                                  names=["shard", "entry", "doc_id", "first", "n", "leads"])
    return run


def _index_writer(path: str):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = _key(pdf["doc_id"].to_numpy())
        table = PerfectHash.of(keys)
        slots = np.zeros(len(keys), SLOT)
        at = table.slots(keys)
        slots["mark"][at], slots["shard"][at], slots["entry"][at] = _mark(keys), pdf["shard"], pdf["entry"]
        share = int(pdf["share"].iloc[0])
        with _Written(f"{path}/index-{share:05d}.mph") as out:
            out.write(table.to_bytes() + slots.tobytes())
        return pd.DataFrame({"share": [share], "keys": [len(keys)]})
    return run


def _load_index(path: str, share: int) -> tuple[PerfectHash, np.ndarray]:
    data = _read(f"{path}/index-{share:05d}.mph")
    table, at = PerfectHash.from_bytes(data)
    return table, np.frombuffer(data, SLOT, -1, at)


def _keyed(df: DataFrame, shares: int) -> DataFrame:
    """``df`` with the ``share`` of its ``doc_id``'s key."""
    @F.pandas_udf("long")
    def share(doc_id: pd.Series) -> pd.Series:
        return pd.Series(_share(_key(doc_id.to_numpy()), shares))
    return df.withColumn("share", share("doc_id"))


_MANIFEST = "shard long, entries long, ids long, ids_before long"
_LAYOUT = "shares long, null_shard long, kind string"


class TokenFiles:
    """A written set of files: ``path``, the manifest, the number of index files
    and the shard that begins with the documents without an id, if any."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path
        self.manifest = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")
        self.shares, self.null_shard, self.kind = spark.read.schema(_LAYOUT).parquet(f"{path}/layout").first()

    def reader(self) -> Reader:
        return Reader(self.path, self.shares, self.null_shard, self.kind)

    def lookup(self, keys: DataFrame, with_ids: bool = True) -> DataFrame:
        """``doc_id, start, n_tokens, ids_crc32`` and, if wanted, ``ids`` (binary) of every document that has
        a ``doc_id`` of ``keys`` (each asked once), by way of the index: ``start`` counts the ids of all
        earlier documents, ``ids`` are 32-bit numbers."""
        path, shares, kind = self.path, self.shares, np.dtype(self.kind)

        def placed(pdf: pd.DataFrame) -> pd.DataFrame:
            try:
                table, slots = _load_index(path, int(pdf["share"].iloc[0]))
            except FileNotFoundError:  # no key has this share
                return pd.DataFrame({"doc_id": [], "shard": [], "entry": []})
            own = _key(pdf["doc_id"].to_numpy())
            at = table.slots(own)
            known = at >= 0
            known[known] = slots["mark"][at[known]] == _mark(own[known])
            found = slots[at[known]]
            return pd.DataFrame({"doc_id": pdf["doc_id"][known].to_numpy(), "shard": found["shard"].astype(np.int64),
                                 "entry": found["entry"].astype(np.int64)})

        def read(batches):
            held = None
            for batch in batches:
                out = []
                for shard, before, entry, doc in zip(*(batch.column(c).to_pylist() for c in (
                        "shard", "before", "entry", "doc_id")), strict=True):
                    if held is None or held[0] != shard:
                        directory = np.frombuffer(_read(f"{path}/shard-{shard:05d}.dir"), ENTRY)
                        held = shard, directory, _read(f"{path}/shard-{shard:05d}.ids")
                    _, directory, payload = held
                    for own in directory[entry:]:
                        if (own["doc_id"], own["no_id"]) != (doc or 0, doc is None):
                            break
                        first, n = int(own["first"]), int(own["n"])
                        ids = np.frombuffer(payload, kind, n, first * kind.itemsize).astype("<u4").tobytes()
                        out.append((doc, before + first, n, zlib.crc32(ids), ids))
                columns = list(zip(*out, strict=True)) if out else [()] * 5
                kinds = [pa.int64()] * 4 + [pa.binary()] * with_ids
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=False)],
                                      names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(kinds)])
        asked = keys.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
        schema = "doc_id long, shard long, entry long"
        places = (_keyed(asked.filter("doc_id is not null"), shares).groupBy("share").applyInPandas(placed, schema))
        if self.null_shard is not None:
            places = places.unionByName(asked.filter("doc_id is null").select(
                "doc_id", F.lit(self.null_shard).cast("long").alias("shard"), F.lit(0).cast("long").alias("entry")))
        shards = self.manifest.select("shard", F.col("ids_before").alias("before"))
        # A shard is read by one task, its entries in order.
        return (places.join(shards, "shard").repartition("shard").sortWithinPartitions("shard", "entry")
                .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"
                            + ", ids binary" * with_ids))


class Reader:
    """Keyed access to single documents, without Spark."""

    def __init__(self, path: str, shares: int, null_shard: int | None = None, kind: str = "<u2"):
        self.path, self.shares, self.null_shard, self.kind = path, shares, null_shard, np.dtype(kind)
        self.indexes: dict[int, tuple[PerfectHash, np.ndarray]] = {}

    def _place(self, doc_id: int | None) -> tuple[int, int] | None:
        if doc_id is None:
            return None if self.null_shard is None else (self.null_shard, 0)
        key = _key(np.array([doc_id]))
        share = int(_share(key, self.shares)[0])
        if share not in self.indexes:
            try:
                self.indexes[share] = _load_index(self.path, share)
            except FileNotFoundError:  # no key has this share
                return None
        table, slots = self.indexes[share]
        at = int(table.slots(key)[0])
        if at < 0 or slots["mark"][at] != _mark(key)[0]:
            return None
        return int(slots["shard"][at]), int(slots["entry"][at])

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of all documents with this id."""
        out = []
        if place := self._place(doc_id):
            shard, entry = place
            while data := _read(f"{self.path}/shard-{shard:05d}.dir", entry * ENTRY.itemsize, ENTRY.itemsize):
                own = np.frombuffer(data, ENTRY)[0]
                if (own["doc_id"], own["no_id"]) != (doc_id or 0, doc_id is None):
                    break
                width = self.kind.itemsize
                ids = _read(f"{self.path}/shard-{shard:05d}.ids", width * int(own["first"]), width * int(own["n"]))
                out.append(np.frombuffer(ids, self.kind))
                entry += 1
        return out


def write(docs: DataFrame, path: str | None = None, tokenizer: str = TOKENIZER, end_id: int = END_ID,
          shard_bytes: int = SHARD_BYTES) -> TokenFiles:
    """Tokenise ``docs`` (``doc_id, text``) into files below ``path`` (default: the shared scratch folder)."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-files")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n, size = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    shards = max(parts_for(size or 0, shard_bytes), parts_for(n))
    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    directory = stored(rows.repartitionByRange(shards, order[0]).sortWithinPartitions(*order)
                       .mapInArrow(_shard_writer(path, tokenizer, end_id), _DIRECTORY), "directory")
    per = directory.groupBy("shard").agg(F.count(F.lit(1)).alias("entries"), F.sum("n").alias("ids"))
    # One row for each shard.
    before = F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")
    per.withColumn("ids_before", before).write.parquet(f"{path}/manifest")
    leads = directory.filter("leads")
    keyed = leads.filter("doc_id is not null")
    shares = parts_for(keyed.count(), KEYS)
    layout = leads.agg(F.lit(shares).cast("long").alias("shares"), F.min(F.when(F.col("doc_id").isNull(), F.col("shard")))
                       .alias("null_shard"), F.lit(_kind(tokenizer)).alias("kind"))
    layout.write.parquet(f"{path}/layout")
    (_keyed(keyed, shares).select("share", "doc_id", "shard", "entry").groupBy("share")
     .applyInPandas(_index_writer(path), "share long, keys long").write.parquet(f"{path}/index"))
    return TokenFiles(spark, path)
