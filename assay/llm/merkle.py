"""A Merkle manifest of a dataset: one hash tree per source, and one over the sources' roots.

Leaves are numbered within their source by a sort over ranges, so a source may span any number of
tasks. A superblock is three levels of a tree, 4096 consecutive nodes. On the way up each superblock is
reduced to one node, and these nodes are the next round's leaves, so a tree of n leaves takes
log_4096(n) rounds. On the way down the nodes of a superblock are cogrouped with what they need from
outside it, the siblings above its top. One `applyInPandas` then reduces the superblock again, joins
the inner and outer siblings to proofs, and folds each leaf, or what it was changed to, up to the root.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.llm.common import ascii_lower
from assay.operators.ordering import positions
from assay.session import same_keys, settle

FAN = 16
LEVELS = 3
#: Rows that one cogroup takes about; it holds whole superblocks of any trees.
CELL_ROWS = 16_384
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def fields_digest(values: Sequence[Column]) -> Column:
    """SHA-256 over the values, each with its length in front; null is a mark that no value can be."""

    def told(value: Column) -> Column:
        text = value.cast("string")
        return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*map(told, values)), 256)


def digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_within(n: int, levels: int = LEVELS) -> int:
    """How many levels of a tree of n nodes lie in a superblock of its lowest ones."""
    return next((k for k in range(levels) if FAN**k >= n), levels)


def local_levels(nodes: list[str], n: int, levels: int) -> list[list[str]]:
    """The nodes of a superblock, level by level; the last level has its top alone."""
    made = [nodes]
    for _ in range(levels_within(n, levels)):
        below = made[-1]
        made.append([digest(below[i : i + FAN]) for i in range(0, len(below), FAN)])
    return made


def siblings(levels: list[list[str]], place: int) -> tuple[list[str], list[str]]:
    """What stands left and right of a node in its run, for each level of the superblock."""
    lefts, rights = [], []
    for level in levels[:-1]:
        first = place - place % FAN
        lefts.append("".join(level[first:place]))
        rights.append("".join(level[place + 1 : first + FAN]))
        place //= FAN
    return lefts, rights


def fold(node: str, lefts: Sequence[str], rights: Sequence[str]) -> str:
    for left, right in zip(lefts, rights):
        node = digest((left, node, right))
    return node


def _in_cells(nodes: DataFrame, rows: int, levels: int) -> DataFrame:
    block = F.floor(F.col("at") / FAN**levels)
    cells = max(1, math.ceil(rows / CELL_ROWS))
    return nodes.withColumn("block", block).withColumn("cell", F.pmod(F.xxhash64("tree", "block"), F.lit(cells)).cast("int"))


def climb(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """(the nodes of each round, (tree, node): the root of each tree).

    `nodes` has tree, n (nodes of the tree), at and node. Each round reduces superblocks to their tops.
    """

    size = FAN**levels

    def tops(group: pd.DataFrame) -> pd.DataFrame:
        found = []
        for (tree, block), part in group.groupby(["tree", "block"]):
            n = int(part["n"].iloc[0])
            found.append((tree, -(-n // size), block, local_levels(part.sort_values("at")["node"].tolist(), n, levels)[-1][0]))
        return pd.DataFrame(found, columns=["tree", "n", "at", "node"])

    rounds, ended = [], []
    while True:
        rows, longest = nodes.agg(F.count("*"), F.max("n")).first()
        rounds.append(_in_cells(nodes, rows, levels))
        columns = ["tree", "n", "at", "node", "block", "cell"]
        reduced = rounds[-1].select(*columns).groupBy("cell").applyInPandas(tops, "tree bigint, n bigint, at bigint, node string")
        reduced = settle(reduced, "tops")
        ended.append(reduced.where("n = 1").select("tree", "node"))
        if (longest or 0) <= size:
            return rounds, reduce(DataFrame.unionByName, ended)
        nodes = reduced.where("n > 1")


#: Of each node: what stands beside it on the way up, and the roots on that way.
PATH = "lefts array<string>, rights array<string>, roots array<string>"


def _joined(levels: list[list[str]], place: int, outer) -> tuple[list[str], list[str]]:
    lefts, rights = siblings(levels, place)
    return [*lefts, *outer["lefts"]], [*rights, *outer["rights"]]


def _exchange(nodes: DataFrame, outer: DataFrame, levels: int, each, schema: str) -> DataFrame:
    """`each(node, lefts, rights, roots)` gives a row for every node.

    `nodes` are cogrouped by their superblock with `outer`, which has tree, block, cell and the path of
    the superblock's top.
    """

    def run(group: pd.DataFrame, outside: pd.DataFrame) -> pd.DataFrame:
        above = {(o["tree"], o["block"]): o for o in outside.to_dict("records")}
        rows = []
        for (tree, block), part in group.groupby(["tree", "block"]):
            part = part.sort_values("at")
            inner = local_levels(part["node"].tolist(), int(part["n"].iloc[0]), levels)
            top = above[tree, block]
            for place, node in enumerate(part.to_dict("records")):
                rows.append(each(node, *_joined(inner, place, top), list(top["roots"])))
        return pd.DataFrame(rows, columns=[f.split()[0] for f in schema.split(", ")])

    return nodes.groupBy("cell").cogroup(outer.groupBy("cell")).applyInPandas(run, schema)


def descend(rounds: list[DataFrame], above: DataFrame, levels: int) -> DataFrame:
    """For the superblocks of the first round: tree, block, cell and the path from their tops to the root.

    `above` has the path of each tree's own root.
    """
    paths = None
    for level in range(len(rounds) - 1, -1, -1):
        cells = rounds[level].groupBy("tree", "block", "cell").agg(F.max("n").alias("n"))
        ended = cells.where(F.col("n") <= FAN**levels).drop("n").join(above, "tree")
        if paths is None:
            outer = ended
        else:
            outer = cells.drop("n").join(paths, ["tree", "block"]).unionByName(ended)
        outer = settle(outer, "outer")
        if level:
            paths = _exchange(
                rounds[level].select("tree", "n", "at", "node", "block", "cell"),
                outer,
                levels,
                lambda node, lefts, rights, roots: (node["tree"], node["at"], lefts, rights, roots),
                f"tree bigint, block bigint, {PATH}",
            )
    return outer


@dataclass
class Manifest:
    """The leaves in their superblocks, what these need from outside, and the roots.

    `leaves` has the key, altered (a leaf to check instead, or null), tree, n, at, node, block and cell;
    `subroots` has source, n, tree and node; `root` is one row with the node, none for an empty table.
    """

    leaves: DataFrame
    outer: DataFrame
    subroots: DataFrame
    root: DataFrame
    levels: int = LEVELS

    def proofs(self) -> DataFrame:
        """(key, leaf, lefts, rights, roots): beside each leaf, level by level, and its subroot and root."""
        kind = self.leaves.schema["key"].dataType.simpleString()
        row = lambda node, lefts, rights, roots: (node["key"], node["node"], lefts, rights, roots)
        return _exchange(self.leaves, self.outer, self.levels, row, f"key {kind}, leaf string, {PATH}")

    def check(self) -> DataFrame:
        """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of the altered leaves, else of the given ones."""
        kind = self.leaves.schema["key"].dataType.simpleString()

        def row(node, lefts, rights, roots):
            proof = digest([side for pair in zip(lefts, rights) for side in pair])
            folded = fold(node["altered"] or node["node"], lefts, rights)
            return node["key"], node["node"], *roots, proof, folded, folded == roots[1]

        return _exchange(
            self.leaves, self.outer, self.levels, row, f"key {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        )


def build(
    df: DataFrame,
    fields: Sequence[str] = FIELDS,
    key: str = "doc_id",
    source: str = "source",
    changed: dict[str, Column] | None = None,
    where: Column | None = None,
    levels: int = LEVELS,
) -> Manifest:
    """The manifest of all rows of `df`.

    A leaf is the digest of `fields`, null unlike any value. Leaves of a source ascend by key; a null key
    comes first, and rows with one key by their leaf. A null source is a source of its own and the first.
    `changed` gives columns to replace in the rows that satisfy `where`; the digests of the rows so
    changed stand in `altered`. A superblock has `levels` levels. Repeated rows are leaves of their own; other columns are not read. The
    text is read once, to be hashed; from then on digests move.
    """
    node = fields_digest([F.col(f) for f in fields])
    altered = F.when(where, fields_digest([(changed or {}).get(f, F.col(f)) for f in fields])) if where is not None else F.lit(None).cast("string")
    leaves = settle(
        df.select(F.col(key).alias("key"), F.col(source).alias("source"), node.alias("node"), altered.alias("altered")), "leaves"
    )
    counts = positions(leaves.groupBy("source").agg(F.count("*").alias("n")), [], ["source"])
    sources = settle(counts.select(F.col("source").alias("named"), "n", F.col("at").alias("tree")), "sources")
    ranked = positions(leaves, ["source"], ["key", "node"])
    ranked = ranked.join(sources, same_keys(ranked, sources, [("source", "named")])).select("key", "altered", "tree", "n", "at", "node")
    rounds, subroots = climb(settle(ranked, "ranked"), levels)
    subroots = settle(subroots, "subroots")

    of_sources = subroots.select(
        F.lit(0).cast("long").alias("tree"), F.lit(sources.count()).cast("long").alias("n"), F.col("tree").alias("at"), "node"
    )
    source_rounds, root = climb(of_sources, levels)
    nothing = F.array().cast("array<string>")
    root = settle(root, "root")
    top = descend(source_rounds, root.select("tree", nothing.alias("lefts"), nothing.alias("rights"), F.array("node").alias("roots")), levels)
    above = _exchange(
        source_rounds[0].select("tree", "n", "at", "node", "block", "cell"),
        top,
        levels,
        lambda node, lefts, rights, roots: (node["at"], lefts, rights, [node["node"], *roots]),
        f"tree bigint, {PATH}",
    )
    outer = descend(rounds, settle(above, "above"), levels)
    named = sources.select(F.col("named").alias("source"), "n", "tree").join(subroots, "tree")
    return Manifest(rounds[0], outer, named, root.select("node"), levels)


#: Every fifth document, by its key's checksum, has its text changed.
TAMPERED = 5


def check_tampered(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", fields: Sequence[str] = FIELDS, levels: int = LEVELS) -> DataFrame:
    """One row per input row: key, leaf, subroot, root, proof_sha256, folded_root and verified.

    In the rows where the CRC-32 of the key as text is a multiple of 5, A-Z of the text are in lower
    case when the proof is checked; a row with a null key is not changed. An empty table gives an empty
    result.
    """
    where = F.crc32(F.col(key).cast("string")) % TAMPERED == 0
    manifest = build(df, fields, key, source, {text: ascii_lower(F.col(text).cast("string"))}, where, levels)
    return manifest.check().withColumnRenamed("key", key)
