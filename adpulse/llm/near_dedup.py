"""Near-duplicate groups from MinHash signatures by an inverted join.

1. A document's set is its distinct word shingles (64-bit hashes); its
   signature the minima of ``COORDINATES`` hash functions.  Documents with equal
   sets are one class, stood for by its smallest id.
2. Classes are posted under each coordinate-value pair.  Pairs that occur once
   can match nothing and go; a class with fewer than ``MATCHES`` others left can
   reach the match threshold with no one and goes too.
3. Prefix: a class is posted only under its rarest m - MATCHES + 1 pairs of m.
   Two classes that agree on MATCHES coordinates share one of these, whatever
   the common values are; long lists are skipped and only looked up when the
   collisions of a candidate pair are counted over the whole signatures.
4. Candidates above the threshold are confirmed on their full sets.

Large groups are not expanded into pairs.  First each member of a list meets
only the list's smallest id.  Pairs above the match threshold make coarse
groups, confirmed ones make components inside them.  Then what a list could
still hide is looked at, so that every two members of a list either are in one
component or were compared:

* members of different coarse groups meet by row, but only those come out of
  the join whose two-bit codes of all coordinates agree often enough to reach
  the threshold (a bound that loses nothing);
* members of one coarse group but different components are compared in blocks
  of bounded size: all outside the largest component against all members.  In a
  block only sets that share one of their rarest members, as any two that reach
  the percentage do, are compared exactly, and only links come out.

At a similarity of 0.8 a pair agrees on 51 of 64 coordinates on average (sd
3.2); fewer than MATCHES = 36 agree with a probability of about 4e-6 (binomial).

Null or empty texts have an empty set and are linked with nothing; rows with a
null id likewise (their component is null).  Rows that share an id are one
document as to links.  Empty tables give empty results.  Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import stored
from adpulse.llm.components import components
from adpulse.llm.substring_dedup import _chunks
from adpulse.llm.wordhash import U, Words, grams, mixed

SHINGLE = 5
PERCENT = 80
COORDINATES = 64
MATCHES = 36

#: Shingles of the two sides of a block of comparisons.
BLOCK, FEW = 200_000, 50_000
_AT_ONCE = 1_000_000
_EVEN_BITS = 0x5555555555555555

_rng = np.random.default_rng(20)
_FACTORS = _rng.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * U(2) + U(1)


def shingle_sets(words: Words, n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``n``-word shingles of each text; a text of
    fewer words has its whole sequence as one."""
    g = grams(words.hash, n)
    sets = []
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        if b - a >= n:
            sets.append(np.unique(g[a:b - n + 1]))
        else:
            sets.append(mixed(grams(words.hash[a:b], b - a) + U(b - a)) if b > a else np.zeros(0, np.uint64))
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``COORDINATES`` 32-bit minima for each set (none may be empty)."""
    out = np.empty((len(sets), COORDINATES), np.uint32)
    if not sets:
        return out
    u = np.concatenate(sets)
    first = np.cumsum([0] + [len(s) for s in sets[:-1]])
    for k in range(COORDINATES):
        y = u * _FACTORS[k]
        y ^= y >> U(32)
        y *= U(0x9FB21C651E98DF25)
        out[:, k] = np.minimum.reduceat(y, first) >> U(32)
    return out


def codes(sig: np.ndarray) -> np.ndarray:
    """Two 64-bit words per signature: the low two bits of 32 coordinates each."""
    two = (sig & 3).astype(np.uint64).reshape(len(sig), 2, COORDINATES // 2)
    return (two << (np.arange(COORDINATES // 2, dtype=np.uint64) * U(2))).sum(axis=2, dtype=np.uint64)


def _sign(shingle: int):
    def run(batches):
        for whole in batches:
            for batch in _chunks(whole):
                sets = shingle_sets(Words(batch.column("text").to_pylist(), lower=True), shingle)
                full = [i for i, s in enumerate(sets) if len(s)]
                sig = signatures([sets[i] for i in full])
                out = [[None] * len(sets) for _ in range(4)]
                for row, code, i in zip(sig.view(np.int32), codes(sig).view(np.int64).tolist(), full, strict=True):
                    key = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                    for col, value in zip(out, (key, row, *code), strict=True):
                        col[i] = value
                yield pa.record_batch([batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                                       pa.array(out[0], pa.binary()), pa.array(out[1], pa.list_(pa.int32())),
                                       pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64())],
                                      names=["doc_id", "n_shingles", "set_key", "sig", "c1", "c2"])
    return run


def _full_sets(shingle: int):
    def run(batches):
        for whole in batches:
            for batch in _chunks(whole):
                sets = shingle_sets(Words(batch.column("text").to_pylist(), lower=True), shingle)
                yield pa.record_batch([batch.column("doc_id"),
                                       pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                                      names=["rep", "members"])
    return run


def _sides(column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, components, set sizes and all members of a block."""
    values = column.values
    members = values.field("members")
    return (values.field("rep").to_numpy(), values.field("component").to_numpy(),
            pa.compute.list_value_length(members).to_numpy(), members.flatten().to_numpy())


def _portions(sizes: np.ndarray):
    """Slices of rows whose sizes add up to about ``_AT_ONCE`` or that have one row."""
    upto = np.cumsum(sizes)
    cuts = np.unique(np.searchsorted(upto, np.arange(_AT_ONCE, upto[-1], _AT_ONCE), "right")) if len(sizes) else []
    ends = [0, *cuts, len(sizes)]
    return [slice(a, b) for a, b in zip(ends[:-1], ends[1:], strict=True) if a < b]


def _spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (n[0] numbers), then the same of the next."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _rarest(of: np.ndarray, code: np.ndarray, df: np.ndarray, n: np.ndarray, percent: int):
    """Row and code of the n - least + 1 rarest members of every set: sets that reach the percentage share one."""
    order = np.lexsort((code, df[code], of))
    place = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    kept = order[place <= np.repeat(n - -(-percent * n // 100), n)]
    return of[kept], code[kept]


def _compare_blocks(percent: int):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                x, cx, nx, mx = _sides(batch.column("few")[i])
                y, cy, ny, my = _sides(batch.column("every")[i])
                nx, ny = nx.astype(np.int64), ny.astype(np.int64)
                kinds, code = np.unique(np.concatenate((mx, my)), return_inverse=True)
                ux, uy = code[:len(mx)], code[len(mx):]
                of_x, of_y = np.repeat(np.arange(len(x)), nx), np.repeat(np.arange(len(y)), ny)
                df = np.bincount(uy, minlength=len(kinds))
                keys = np.sort(of_y * len(kinds) + uy)
                px, vx = _rarest(of_x, ux, df, nx, percent)
                py, vy = _rarest(of_y, uy, df, ny, percent)
                by_code = np.argsort(vy, kind="stable")
                py, vy = py[by_code], vy[by_code]
                low = vy.searchsorted(vx)
                hits = vy.searchsorted(vx, "right") - low
                first_x = np.cumsum(nx) - nx
                for part in _portions(hits):
                    pair = np.unique(np.repeat(px[part], hits[part]) * len(y) + py[_spread(low[part], hits[part])])
                    j, k = pair // len(y), pair % len(y)
                    open_ = (cx[j] != cy[k]) & (100 * np.minimum(nx[j], ny[k]) >= percent * np.maximum(nx[j], ny[k]))
                    j, k = j[open_], k[open_]
                    for some in _portions(nx[j]):
                        a, b = j[some], k[some]
                        wanted = np.repeat(b, nx[a]) * len(kinds) + ux[_spread(first_x[a], nx[a])]
                        there = keys[np.minimum(keys.searchsorted(wanted), len(keys) - 1)] == wanted
                        both = np.add.reduceat(there.astype(np.int64), np.cumsum(nx[a]) - nx[a])
                        linked = 100 * both >= percent * (nx[a] + ny[b] - both)
                        # One link from each member to each other component is enough.
                        links = {(int(x[p]), int(cy[q])): int(y[q]) for p, q in zip(a[linked], b[linked], strict=True)}
                        yield pa.record_batch([pa.array([p for p, _ in links], pa.int64()),
                                               pa.array(list(links.values()), pa.int64())], names=["a", "b"])
    return run


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row: documents whose
    sets have ``100 * intersection >= percent * union`` are linked."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stored(texts.mapInArrow(_sign(shingle), "doc_id long, n_shingles long, set_key binary, sig array<int>, "
                                                     "c1 long, c2 long"), "signatures")
    classes = stored(signed.filter("n_shingles > 0 and doc_id is not null").groupBy("set_key").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"),
        F.first("c1").alias("c1"), F.first("c2").alias("c2")), "classes")

    pairs_of = classes.select("rep", F.posexplode("sig").alias("i", "v")).select(
        "rep", (F.shiftleft(F.col("i").cast("long"), 32) + (F.col("v").cast("long").bitwiseAND(0xFFFFFFFF)))
        .alias("token"))
    shared = pairs_of.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    live = (pairs_of.join(shared, "token").groupBy("rep")
            .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("tokens"))
            .filter(F.size("tokens") >= MATCHES)
            .join(classes.select("rep", "n", "c1", "c2"), "rep"))
    postings = stored(live.select("rep", "n", "c1", "c2", F.explode(
        F.expr(f"slice(tokens, 1, size(tokens) - {MATCHES - 1})")).alias("t"))
        .select("rep", "n", "c1", "c2", "t.token"), "postings")

    def near_enough(x: str, y: str) -> Column:
        """Sizes and codes of rows ``x`` and ``y`` allow a match; holds for every pair above the threshold."""
        def differ(c):
            d = F.col(f"{x}.{c}").bitwiseXOR(F.col(f"{y}.{c}"))
            return F.bit_count(d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseAND(F.lit(_EVEN_BITS)))
        sizes = 100 * F.least(f"{x}.n", f"{y}.n") >= percent * F.greatest(f"{x}.n", f"{y}.n")
        return sizes & (differ("c1") + differ("c2") <= COORDINATES - MATCHES)

    def matched(candidates: DataFrame) -> DataFrame:
        """Candidates ``a, b`` with enough collisions over the whole signatures."""
        def side(x):
            return classes.select(F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("sig").alias(f"s{x}"))
        collisions = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda t, x: t + x)
        return (candidates.join(side("a"), "a").join(side("b"), "b").filter(collisions >= MATCHES)
                .select("a", "b", "na", "nb"))

    hubs = postings.groupBy("token").agg(F.min(F.struct("rep", "n", "c1", "c2")).alias("hub"),
                                         F.count(F.lit(1)).alias("c")).filter("c > 1").select("token", "hub.*")
    p, h = postings.alias("p"), hubs.alias("h")
    to_hubs = (p.join(h, (F.col("p.token") == F.col("h.token")) & (F.col("p.rep") != F.col("h.rep")) & near_enough("p", "h"))
               .select(F.col("p.rep").alias("a"), F.col("h.rep").alias("b")).distinct())
    likely = stored(matched(to_hubs), "likely")
    coarse = components(likely)
    known = (postings.join(coarse.select(F.col("node").alias("rep"), F.col("component").alias("coarse")), "rep", "left")
             .withColumn("coarse", F.coalesce("coarse", "rep")))
    known = stored(known, "known")

    # Members of different coarse groups in one list.
    lists = (known.groupBy("token", "coarse").agg(F.count(F.lit(1)).alias("c"))
             .groupBy("token").agg(F.max(F.struct("c", "coarse"))["coarse"].alias("largest"),
                                   F.count(F.lit(1)).alias("kinds")).filter("kinds > 1").drop("kinds"))
    several = known.join(lists, "token")
    x, y = several.filter("coarse <> largest").alias("x"), several.alias("y")
    met = (x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.coarse") != F.col("y.coarse"))
                  # Two outside the largest group meet once only, from the smaller id.
                  & ((F.col("y.coarse") == F.col("y.largest")) | (F.col("x.rep") < F.col("y.rep"))) & near_enough("x", "y"))
           .select(F.greatest("x.rep", "y.rep").alias("a"), F.least("x.rep", "y.rep").alias("b")).distinct())
    across = stored(matched(met), "across")

    # Full sets of all that is to be confirmed or compared.
    wanted = stored(likely.select("a").union(likely.select("b")).union(across.select("a")).union(across.select("b"))
                    .toDF("rep").distinct(), "wanted")
    sets = stored(texts.join(wanted, F.col("doc_id") == F.col("rep"), "left_semi")
                  .mapInArrow(_full_sets(shingle), "rep long, members array<long>")
                  .groupBy("rep").agg(F.first("members").alias("members")), "sets")

    def confirmed(candidates: DataFrame) -> DataFrame:
        def members(x):
            return sets.select(F.col("rep").alias(x), F.col("members").alias(f"m{x}"))
        both = F.size(F.array_intersect("ma", "mb"))
        return (candidates.join(members("a"), "a").join(members("b"), "b")
                .filter(100 * both >= percent * (F.col("na") + F.col("nb") - both)).select("a", "b"))
    fine = components(stored(confirmed(likely), "links"))

    # Members of one coarse group in different components.
    grouped = (coarse.withColumnsRenamed({"node": "rep", "component": "coarse"})
               .join(fine.withColumnRenamed("node", "rep"), "rep", "left")
               .withColumn("component", F.coalesce("component", "rep"))
               .join(classes.select("rep", "n"), "rep"))
    split = (grouped.groupBy("coarse", "component").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("n"))
             .groupBy("coarse").agg(F.max(F.struct("c", "component", "n")).alias("largest"), F.count(F.lit(1)).alias("kinds"),
                                    F.sum("n").alias("n")).filter("kinds > 1")
             .select("coarse", F.col("largest.component").alias("largest"),
                     F.ceil(F.col("n") / BLOCK).alias("blocks"),
                     F.ceil((F.col("n") - F.col("largest.n")) / FEW).alias("few_blocks")))
    inside = grouped.drop("n").join(split, "coarse").join(sets, "rep")

    def dealt(df: DataFrame, n: str, name: str, *more: str) -> DataFrame:
        return (df.withColumn("part", F.pmod(F.xxhash64("rep"), F.col(n))).groupBy("coarse", "part", *more)
                .agg(F.collect_list(F.struct("rep", "component", "members")).alias(name)))
    every = dealt(inside, "blocks", "every")
    few = (dealt(inside.filter("component <> largest"), "few_blocks", "few", "blocks").drop("part")
           .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))))
    within = (few.join(every, ["coarse", "part"]).select("few", "every")
              .mapInArrow(_compare_blocks(percent), "a long, b long"))

    more = stored(confirmed(across).unionByName(within), "links")
    joined = (more.join(fine.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left")
              .join(fine.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
              .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    merged = components(joined)

    group = (classes.select("set_key", "rep")
             .join(fine.withColumnRenamed("node", "rep"), "rep", "left")
             .withColumn("component", F.coalesce("component", "rep"))
             .join(merged.select(F.col("node").alias("component"), F.col("component").alias("last")), "component", "left")
             .select("set_key", F.coalesce("last", "component").alias("component")))
    component = F.coalesce("component", "doc_id")
    return (signed.select("doc_id", "n_shingles", "set_key").join(group, "set_key", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def keep_one_of_each(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` without near-duplicates of a document with a smaller id; all columns kept."""
    gone = near_duplicates(docs, shingle, percent).filter("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
