"""Manifest, hard negatives and token files against brute force, on awkward rows and on no rows."""

import collections
import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_llm_operators import TEXTS, frame

from adpulse.llm import hard_negatives, token_files
from adpulse.llm.hard_negatives import LengthBucket, shifted_sevenths
from adpulse.llm.merkle import fold, lowered_thirds, manifest
from adpulse.llm.queries import QUERIES
from adpulse.llm.ranking import ranked
from adpulse.llm.token_files import PerfectHash, PieceTokenizer, Reader, write

SF = "/root/testdata/sf0.001"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# --- ranks

def test_ranks_spread_a_group(spark, monkeypatch):
    monkeypatch.setattr("adpulse.llm.ranking.PER_PARTITION", 50)
    rows = [("hot" if i % 3 else "b", i * 7919 % 1009) for i in range(700)]
    got = ranked(spark.createDataFrame(rows, "g string, x int"), "g", [F.col("x")]).collect()
    for g in ("hot", "b"):
        own = sorted(x for k, x in rows if k == g)
        assert sorted((r["rank"], r["x"], r["size"]) for r in got if r["g"] == g) == [
            (i, x, len(own)) for i, x in enumerate(own)]


# --- Merkle manifest

def _framed(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute_manifest(rows, fan=8):
    """rows: (doc_id, source, lang, n_chars, text); leaf, changed leaf and proof by lists alone."""
    def tree(nodes):
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for k, i in enumerate(at):
                run = i // fan * fan
                paths[k].append((nodes[run:i], nodes[i + 1:run + fan]))
            nodes = [H(*nodes[i:i + fan]) for i in range(0, len(nodes), fan)]
            at = [i // fan for i in at]
        return nodes[0], paths
    by_lang = collections.defaultdict(list)
    for doc, source, lang, n, text in rows:
        own = H(*map(_framed, (doc, source, lang, n, text)))
        hit = doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0
        low = None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        by_lang[lang].append((doc is not None, doc or 0, own, H(*map(_framed, (doc, source, lang, n, low))) if hit else own, doc))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda r: r[:3])
        trees[lang] = tree([r[2] for r in by_lang[lang]])
    root, outer = tree([trees[x][0] for x in langs])
    out = []
    for lang, above in zip(langs, outer, strict=True):
        for (_, _, own, changed, doc), path in zip(by_lang[lang], trees[lang][1], strict=True):
            node = changed
            for before, after in path + above:
                node = H(*before, node, *after)
            out.append((doc, own, trees[lang][0], root, H(*(x for b, a in path + above for x in b + a)), node, node == root))
    return sorted(out, key=str)


def _docs(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_manifest_equals_brute_force(spark, levels):
    docs = frame(spark, TEXTS + [(100 + i, f"Text {i}") for i in range(200)]).withColumn(
        "lang", F.when(F.col("doc_id") > 110, F.concat(F.lit("l"), (F.col("doc_id") % 11).cast("string"))).otherwise(F.col("lang")))
    got = manifest(docs, *lowered_thirds(F.col("doc_id"), F.col("text")), span=levels)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    rows = sorted(map(tuple, got.collect()), key=str)
    assert rows == brute_manifest(_docs(docs))
    assert {True, False} == {r[-1] for r in rows}


@pytest.mark.parametrize("n", [0, 1, 8, 9, 65])
def test_manifest_of_one_language(spark, n):
    docs = frame(spark, [(i, f"a{i}") for i in range(n)]).withColumn("lang", F.lit("en"))
    got = manifest(docs, proofs=True, span=1).collect()
    want = [r[:4] for r in brute_manifest(_docs(docs))] if n else []
    assert sorted((tuple(r)[:4] for r in got), key=str) == want
    # Without tampering every leaf folds to the root; a changed leaf or proof does not.
    for r in got:
        assert r["verified"] and fold(r["leaf"], r["proof"]) == r["root"] and H(*r["proof"]) == r["proof_sha256"]
        assert fold(H("x"), r["proof"]) != r["root"]


def test_manifest_query(spark):
    rows = QUERIES["op11_merkle_manifest"](spark, SF).collect()
    assert sorted(map(tuple, rows), key=str) == brute_manifest(_docs(spark.read.parquet(f"{SF}/documents.parquet")))


# --- hard negatives

def brute_negatives(rows, is_anchor, k=5, low=80):
    """rows: (id, vector of whole numbers, label)."""
    out = set()
    for own, a, label in rows:
        if not is_anchor(own):
            continue
        score = [(-int(a @ v), i, other) for i, v, other in rows if i != own and len(v) == len(a)]
        for p, positive, _ in sorted(x for x in score if x[2] == label)[:k]:
            inside = sorted(x for x in score if x[2] != label and low * -p <= 100 * -x[0] <= 100 * -p)[:k]
            out |= {(own, positive, n + 1, i, -p, -s) for n, (s, i, _) in enumerate(inside)}
    return out


VECTOR_SCHEMA = "vec_id long, embedding array<float>, label int, bucket string, kin int, anchor int"


def _vectors(spark, rows):
    return spark.createDataFrame([(*r, "b", 1, 2) for r in rows], VECTOR_SCHEMA).repartition(3)


def _whole(rows):
    return [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(np.int64), c) for i, v, c in rows
            if i is not None and c is not None and v and None not in v and np.isfinite(np.array(v, float)).all()]


@pytest.mark.parametrize("spread, components", [(0.1, 64), (1.0, 256), (4.0, 1 << 18)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, spread, components):
    monkeypatch.setattr(hard_negatives, "COMPONENTS", components)
    monkeypatch.setattr(hard_negatives, "ASKED", 3)
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((3, 8))
    rows = [(i, (rng.choice([0.5, 1, 3]) * (centres[i % 3] + spread * rng.standard_normal(8))).tolist(),
             int(rng.integers(4))) for i in range(150)]
    rows += [(200 + i, rows[0][1], 3) for i in range(10)]  # one vector many times, one of them repeated
    rows += [rows[-1], (300, [0.0] * 8, 1), (301, [1.0, 2.0], 1), (302, [1.0, 2.0], 2), (303, [2.0, 2.0], 1)]
    rows += [(310, None, 1), (311, [], 1), (312, [1.0, None] + [0.0] * 6, 1), (313, [float("nan")] * 8, 1),
             (314, [float("inf")] + [0.0] * 7, 1), (315, rows[1][1], None), (None, rows[1][1], 1), (320, [-x for x in rows[3][1]], 2)]
    got = hard_negatives.hard_negatives(_vectors(spark, rows), F.col("vec_id") % 10 == 0)
    want = brute_negatives(_whole(rows), lambda i: i % 10 == 0)
    rows = [tuple(r) for r in got.collect()]
    assert set(rows) == want and got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert len(want) > 50


def test_candidates_lose_nothing_and_prune():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((10, 16))
    v = np.floor(256 * (centres[np.arange(500) % 10] + 0.1 * rng.standard_normal((500, 16)))).astype(np.int64)
    bucket = LengthBucket(np.arange(500), np.zeros(500), v)
    left = []
    for a in v[:40]:
        score = v @ a
        for reach in np.quantile(score, [0.9, 0.99, 1.0]).astype(int):
            if reach > 0:
                found = bucket.candidates(a, float(np.sqrt(a @ a)), int(reach))
                assert set(np.flatnonzero(score >= reach)) <= set(found.tolist())
                left.append(len(found))
    assert min(left) < 100 and np.median(left) < 300


def test_scores_beyond_doubles():
    v = np.full((3, 4), (1 << 26) - 1, np.int64)
    assert LengthBucket(np.arange(3), np.zeros(3), v).scores(v[0], slice(None)).tolist() == [4 * ((1 << 26) - 1) ** 2] * 3


def test_hard_negatives_of_none(spark):
    assert hard_negatives.hard_negatives(_vectors(spark, []), F.col("vec_id") % 10 == 0).collect() == []
    one = _vectors(spark, [(0, [1.0, 2.0], 1)])
    assert hard_negatives.hard_negatives(one, F.col("vec_id") % 10 == 0).collect() == []


def test_hard_negatives_query(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in
            shifted_sevenths(spark.read.parquet(f"{SF}/embeddings.parquet")).collect()]
    got = {tuple(r) for r in QUERIES["op12_hard_negatives"](spark, SF).collect()}
    assert got == brute_negatives(_whole(rows), lambda i: i % 100 == 0)


# --- token files

def _tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(token_files.TOKENIZER))


ODD = ["", " ", "  ", "a", " a", "a  b", "a \n b", "a\n\n b  ", "a   ", "　b c  d", "it's  we'll \t x", "x<|endoftext|>  <|endoftext|> y",
       "é  ü z ​ a", "1 2  34 . .. !  ?", "a" * 500 + " " + "b" * 500, "\r\n a\x0bb \x1c c \x85 d", " ́ a", "日本 語  テ キスト", "a\nb. c\n\nd,\n\n\ne", "a\n\n", "a\n\n b", "\na", "\n\na", "\n", "a \nb", "a\n b", "x²\n½ y_z"]


def test_pieces_give_the_ids_of_the_whole(monkeypatch):
    import public_tokenizers

    rng = np.random.default_rng(1)
    parts = [*"ab1.'é ", "  ", "\n", "\t", " \n ", "don't", " ", " ", "<|endoftext|>", "語", "!!", "\x1c"]
    monkeypatch.setattr(token_files, "_SLICE", 10)
    texts = ODD + ["".join(rng.choice(parts, 30)) for _ in range(2000)]
    whole = [np.array(e.ids, "<u2").tobytes() for e in _tokenizer().encode_batch(texts, add_special_tokens=False)]
    fast = PieceTokenizer(public_tokenizers.path(token_files.TOKENIZER), remembered=5_000)
    assert [x for i in range(0, len(texts), 37) for x in fast.ids(pa.array(texts[i:i + 37]))] == whole
    assert fast.held < 500_000


def test_perfect_hash():
    for n in (0, 1, 2, 1000, 30_000):
        keys = token_files._key(np.random.default_rng(n).choice(1 << 40, n, replace=False))
        table, took = PerfectHash.from_bytes(PerfectHash.of(keys).to_bytes() + b"rest")
        assert sorted(table.slots(keys).tolist()) == list(range(n))
        assert took == len(PerfectHash.of(keys).to_bytes())
        foreign = table.slots(token_files._key(np.arange(1 << 41, (1 << 41) + 500)))
        assert ((foreign >= -1) & (foreign < max(n, 1))).all()


def test_keys_beyond_all_levels_are_listed(monkeypatch):
    monkeypatch.setattr(token_files, "MOST_LEVELS", 1)
    keys = token_files._key(np.arange(5000))
    table = PerfectHash.from_bytes(PerfectHash.of(keys).to_bytes())[0]
    assert len(table.rest) and sorted(table.slots(keys).tolist()) == list(range(5000))


def brute_tokens(rows):
    tokenizer, out, at = _tokenizer(), [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        at += len(ids)
    return out


@pytest.mark.parametrize("shard_bytes, keys", [(1 << 30, 1 << 30), (3000, 7)])
def test_token_files_round_trip(spark, monkeypatch, shard_bytes, keys):
    monkeypatch.setattr(token_files, "KEYS", keys)
    texts = TEXTS + [(40 + i, t) for i, t in enumerate(ODD)] + [(0, "zero"), (-5, "negative"), (1 << 60, "large")]
    files = write(frame(spark, texts), shard_bytes=shard_bytes)
    want = brute_tokens(texts)
    got = files.lookup(frame(spark, texts)).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted((tuple(r)[:4] for r in got), key=key) == [r[:4] for r in want]
    assert {(r["doc_id"], r["start"]): np.frombuffer(r["ids"], "<u4").tolist() for r in got} == {(r[0], r[1]): r[4] for r in want}
    n_shards = files.manifest.count()
    assert (n_shards > 3) == (shard_bytes == 3000)
    assert files.manifest.agg(F.sum("ids")).first()[0] == want[-1][1] + want[-1][2]
    # A part of the keys, and keys that no document has.
    some = spark.createDataFrame([(8,), (8,), (None,), (12345,), (-6,), (0,)], "doc_id long")
    assert sorted((tuple(r) for r in files.lookup(some, with_ids=False).collect()), key=key) == [
        r[:4] for r in want if r[0] in (8, None, 0)]
    one = files.reader()
    assert isinstance(one, Reader)
    for doc in (8, None, 17, -5, 1 << 60, 12345):
        assert [x.tolist() for x in one.get(doc)] == [r[4] for r in want if r[0] == doc]


def test_no_token_files(spark):
    empty = frame(spark, [])
    files = write(empty)
    asked = spark.createDataFrame([(1,), (None,)], "doc_id long")
    assert files.lookup(asked).collect() == [] and files.manifest.count() == 0
    assert files.reader().get(1) == [] and files.reader().get(None) == []


def test_token_files_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op13_token_files"](spark, SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == [r[:4] for r in brute_tokens(docs)]
