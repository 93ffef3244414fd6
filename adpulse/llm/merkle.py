"""Merkle manifest of a dataset: digests, inclusion proofs and their verification.

A row's leaf is the SHA-256 of its columns, each with its length in front.  The
leaves of a language ascend by ``doc_id`` and are reduced in runs of ``FAN``
until one node remains, the language's subroot; the subroots are reduced to the
root in the same way.

The work is cut into superblocks of ``FAN ** LEVELS`` consecutive nodes.  Upwards,
each superblock becomes one node, and those nodes are cut into superblocks again
until a tree has one node left, so a round has 1/4096 of the rows of the round
before and a tree of any size takes few rounds.  Downwards, the nodes of a
superblock are cogrouped with the one row that holds what lies outside: root,
subroot and the siblings on the way from the superblock's top to the root.  In
that cogroup (``applyInPandas``) the local reduction is done again, each node's
siblings are joined to the outer ones, and the proof is folded to a root.  No task
holds more than one superblock and its path, whatever share of the rows one
language has.

A proof is a list of strings, two for each level: the digests before and after
the node in its run (both empty for a run of one).

Nulls: a null column counts as ``-``, a null language is a tree of its own (first
among the subroots), rows with a null id come first in their tree.  Rows with
the same id are ordered by leaf; rows that repeat everything have equal leaves,
so it does not matter which comes first.  Empty texts have length 0.  Texts of
any length are hashed in the JVM and go no further.  An empty table gives an
empty result.  Only the five columns are read, so further ones never clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import stored
from adpulse.llm.ranking import ranked

FAN = 8
#: Levels that a superblock spans.
LEVELS = 4
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _framed(value: Column) -> Column:
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(docs: DataFrame, text: Column | None = None) -> Column:
    """The leaf of a row of ``docs``, with another ``text`` if given."""
    kinds = {"doc_id": "long", "n_chars": "long"}
    values = [F.col(c).cast(kinds.get(c, "string")).cast("string") for c in COLUMNS[:-1]]
    return F.sha2(F.concat(*map(_framed, [*values, F.col("text").cast("string") if text is None else text])), 256)


def reduced(nodes: Sequence[str], levels: int | None) -> list[list[str]]:
    """All levels from ``nodes`` up: so many, or until one node remains."""
    out = [list(nodes)]
    while len(out) <= levels if levels is not None else len(out[-1]) > 1:
        below = out[-1]
        out.append([digest("".join(below[i:i + FAN])) for i in range(0, len(below), FAN)])
    return out


def fold(node: str, proof: Iterable[str]) -> str:
    """The root that a node and its siblings lead to."""
    sides = iter(proof)
    for before, after in zip(sides, sides, strict=True):
        node = digest(before + node + after)
    return node


def _path(levels: list[list[str]], at: int) -> list[str]:
    path = []
    for level in levels[:-1]:
        first = at - at % FAN
        path += ["".join(level[first:at]), "".join(level[at + 1:first + FAN])]
        at //= FAN
    return path


def _local(pdf: pd.DataFrame, span: int) -> tuple[pd.DataFrame, list[list[str]]]:
    """A superblock's nodes in order and its levels; one that is a whole tree ends at a single node."""
    pdf = pdf.sort_values("rank")
    return pdf, reduced(pdf["node"], span if pdf["size"].iloc[0] > FAN ** span else None)


def _top(span: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, levels = _local(pdf, span)
        return pd.DataFrame({"tree": pdf["tree"].iloc[:1].tolist(), "rank": pdf["block"].iloc[:1].tolist(),
                             "size": [-(-int(pdf["size"].iloc[0]) // FAN ** span)], "node": levels[-1]})
    return run


def _with_paths(span: int):
    def run(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes, levels = _local(nodes, span)
        rest = list(outer["path"].iloc[0])
        return nodes[["tree", "rank", "node"]].assign(
            root=outer["root"].iloc[0], subroot=outer["subroot"].iloc[0],
            path=[_path(levels, i) + rest for i in range(len(nodes))])
    return run


def _verified(span: int, proofs: bool):
    def run(leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        leaves, levels = _local(leaves, span)
        rest = list(outer["path"].iloc[0])
        root, out = outer["root"].iloc[0], []
        for i, (own, changed) in enumerate(zip(leaves["node"], leaves["changed"], strict=True)):
            proof = _path(levels, i) + rest
            folded = fold(changed or own, proof)
            out.append((digest("".join(proof)), folded, folded == root, *([proof] if proofs else [])))
        names = ["proof_sha256", "folded_root", "verified", *(["proof"] if proofs else [])]
        return pd.concat([leaves[["doc_id", "node"]].reset_index(drop=True).set_axis(["doc_id", "leaf"], axis=1)
                          .assign(subroot=outer["subroot"].iloc[0], root=root), pd.DataFrame(out, columns=names)], axis=1)
    return run


def _blocks(nodes: DataFrame, span: int):
    return nodes.withColumn("block", F.expr(f"rank div {FAN ** span}")).groupBy("tree", "block")


_NODES = "tree string, rank long, size long, node string"
_PATHS = "tree string, rank long, node string, root string, subroot string, path array<string>"


def _rounds(nodes: DataFrame, span: int) -> list[DataFrame]:
    """``nodes`` and the tops of each round until every tree has one node."""
    out = [nodes]
    while (out[-1].agg(F.max("size")).first()[0] or 0) > 1:
        kept = out[-1].select("tree", "rank", "size", "node")
        out.append(stored(_blocks(kept, span).applyInPandas(_top(span), _NODES), "tops"))
    return out


def _cogrouped(nodes: DataFrame, outer: DataFrame, span: int, run, schema: str) -> DataFrame:
    return _blocks(nodes, span).cogroup(outer.groupBy("tree", "block")).applyInPandas(run, schema)


def _paths(nodes: DataFrame, outer: DataFrame, span: int) -> DataFrame:
    return _cogrouped(nodes.select("tree", "rank", "size", "node"), outer, span, _with_paths(span), _PATHS)


def _descended(rounds: list[DataFrame], outer: DataFrame, span: int) -> DataFrame:
    """From the paths of trees' tops to those of the superblocks of the first round."""
    for nodes in reversed(rounds[1:]):
        outer = stored(_paths(nodes, outer, span)
                       .select("tree", F.col("rank").alias("block"), "root", "subroot", "path"), "outer")
    return outer


def manifest(docs: DataFrame, tampered: Column | None = None, text: Column | None = None,
             proofs: bool = False, span: int = LEVELS) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of
    every row of ``docs``; with ``proofs`` also the proof itself.  A superblock spans ``span`` levels.

    Rows for which ``tampered`` holds are verified with the leaf that they have
    with ``text`` instead of their own; all else is of the untouched rows.
    """
    changed = F.lit(None).cast("string") if tampered is None else F.when(tampered, leaf(docs, text))
    # The key of a tree sorts as its language does by bytes, null first.
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-"))
    leaves = stored(docs.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
                                leaf(docs).alias("node"), changed.alias("changed")), "leaves")
    in_order = ranked(leaves, "tree", [F.col("doc_id").asc_nulls_first(), F.col("node")])
    # pandas would make a number of a null id's column.
    trees = _rounds(stored(in_order.withColumn("doc_id", F.col("doc_id").cast("string")), "ranked"), span)

    subroots = trees[-1].select(F.lit("").alias("tree"), F.col("tree").alias("of"), "node")
    subroots = stored(ranked(subroots, "tree", [F.col("of")]), "subroots")
    tops = _rounds(subroots, span)
    root = tops[-1].select("tree", F.lit(0).cast("long").alias("block"), F.col("node").alias("root"),
                           F.lit("").alias("subroot"), F.array().cast("array<string>").alias("path"))
    above = _paths(subroots, _descended(tops, root, span), span)
    outer = stored(above.select("rank", "root", "path").join(subroots.select("rank", "of", "node"), "rank")
                   .select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("block"), "root",
                           F.col("node").alias("subroot"), "path"), "outer")
    schema = ("doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
              "verified boolean" + ", proof array<string>" * proofs)
    out = _cogrouped(trees[0], _descended(trees, outer, span), span, _verified(span, proofs), schema)
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def lowered_thirds(doc_id: Column, text: Column) -> tuple[Column, Column]:
    """The tampering of the contract: where 3 divides the id's CRC-32, A-Z of the text in lower case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    hit = F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    return hit, F.translate(text.cast("string"), upper, upper.lower())
