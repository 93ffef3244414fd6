"""The corpus pipeline against a brute-force run, and its registration."""

import collections
import zlib

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from adpulse.llm import langid
from test_llm_operators import brute_components, brute_targets, check_packed, split

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    model = langid.fit(docs.filter(~langid.held_out(docs.doc_id)))
    kept = [r for r in rows if not model.predict(r.text)[2]]
    seen, unique = set(), []
    for r in sorted(kept, key=lambda r: r.doc_id):
        words = " ".join(split(r.text))
        if (plain := (r.text[:1].isspace(), words, r.text[-1:].isspace())) not in seen:
            seen.add(plain)
            unique.append(r)
    stay = {i for i, _, c in brute_components([(r.doc_id, r.text) for r in unique], 5) if i == c}
    want = [kept, unique, [r for r in unique if r.doc_id in stay]]
    current = docs
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        current = stage(spark, current, SF)
        if n < 4:
            assert current.columns == docs.columns
            path = f"{spark.sparkContext.getCheckpointDir()}/test-{n}-{id(current)}"
            current.write.parquet(path)
            current = spark.read.parquet(path)
        if n < 3:
            assert sorted(map(tuple, current.collect())) == sorted(map(tuple, want[n]))
        elif n == 3:
            mixed = current.collect()
            by_source = collections.Counter()
            for r in want[2]:
                by_source[r.source] += len(split(r.text))
            target, taken = brute_targets(by_source), collections.Counter()
            for r in mixed:
                taken[r.source] += len(split(r.text))
            assert set(mixed) <= set(want[2]) and max(collections.Counter(mixed).values()) <= 3
            longest = max(len(split(r.text)) for r in want[2])
            assert all(abs(taken[s] - target[s]) <= 3 * longest for s in target)
        else:
            assert check_packed(current.collect(), [(r.doc_id, r.text) for r in mixed]) < 0.02


def test_registered():
    names = entry.queries()
    assert corpus_pipeline.run is not None and "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert zlib.crc32(b"") == 0 and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", ["op4_sharding", "op10_html_extraction", "op8_exact_dedup"])
def test_columns(spark, name):
    want = {"op4_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
            "op10_html_extraction": ["page_id", "url", "text", "n_chars"],
            "op8_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]}[name]
    assert entry.queries()[name](spark, SF).columns == want
