"""Merkle manifest of a table as a persistent tree in aligned blocks.

1. A row becomes a leaf: the digest of its fields, each with its length (``leaves``, built-in
   functions over the scan; the texts themselves go no further).
2. Leaves are numbered within their group in the order of their key, by a range shuffle and
   slice offsets, so no group needs one task. Every ``width ** block_levels`` neighbours are a
   block. A task folds one block to its root; block roots are the leaves of the next round,
   until each group has one subroot (``build``). The subroots, in the order of their groups,
   are folded the same way to the root.
3. Back down, each block hands its members their siblings: a node's path is that within its
   block and then that of its block (``Manifest.rows``). A leaf's path is its proof.
4. A changed leaf makes a new version of the tree. Within a block the tree is persistent:
   ``PersistentTree.changed`` copies the ancestors of the leaf and shares every other node with
   the versions before it. Above the block the version goes on in the same task along the path that the
   block was handed, which all versions of the block share; so versions are spread as blocks
   are and none of the upper blocks ever holds the versions below it.

Digests are lowercase hex SHA-256 and are hashed as such text. A run of ``width`` neighbours
(the last one fewer, even one) becomes one node, while more than one node is left.

Defined results: a null field is ``-``, else its UTF-8 byte count, ``:`` and its value; a null
group is a group of its own and the first; null keys come first in their group; rows of
equal key are ordered by their digest and are leaves each; a change that leaves the fields as
they are (null stays null) makes a version with the same root; an empty table gives an empty
result; columns that are not asked for are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segrec.llm.common import arrow_schema, materialise
from segrec.operators.ranking import rank_within_groups

WIDTH = 2
BLOCK_LEVELS = 10  # a block has WIDTH ** BLOCK_LEVELS leaves: what one task holds at a time

_NODES = "seq string, pos long, digest string, n long"
_PATH = "array<struct<before:string,after:string>>"


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


class PersistentTree:
    """The tree over one block. Nodes are never changed: a version is a root of its own.

    ``digests`` and ``children`` hold all nodes of all versions, a node is its place there."""

    def __init__(self, leaves: Sequence[str], levels: int, width: int = WIDTH):
        self.levels, self.width = levels, width
        self.digests: list[str] = list(leaves)
        self.children: list[tuple[int, ...]] = [()] * len(leaves)
        nodes = list(range(len(leaves)))
        for _ in range(levels):
            nodes = [self._node(tuple(nodes[k:k + width])) for k in range(0, len(nodes), width)]
        (self.root,) = nodes

    def _node(self, children: tuple[int, ...]) -> int:
        self.digests.append(digest(*map(self.digests.__getitem__, children)))
        self.children.append(children)
        return len(self.digests) - 1

    def _descend(self, root: int, place: int) -> list[tuple[int, int]]:
        """(node, which child) from the root down to the parent of a leaf."""
        steps = []
        for level in range(self.levels - 1, -1, -1):
            which = place // self.width ** level % self.width
            steps.append((root, which))
            root = self.children[root][which]
        return steps

    def changed(self, root: int, place: int, leaf: str) -> int:
        """The root of a new version in which one leaf differs; copies that leaf's ancestors alone."""
        steps = self._descend(root, place)
        self.digests.append(leaf)
        self.children.append(())
        node = len(self.digests) - 1
        for parent, which in reversed(steps):
            old = self.children[parent]
            node = self._node((*old[:which], node, *old[which + 1:]))
        return node

    def path(self, root: int, place: int) -> list[dict[str, str]]:
        """The siblings of a leaf and its ancestors, lowest first: digests before and after, joined."""
        found = []
        for parent, which in reversed(self._descend(root, place)):
            around = [self.digests[c] for c in self.children[parent]]
            found.append({"before": "".join(around[:which]), "after": "".join(around[which + 1:])})
        return found

    def ancestors(self, root: int, place: int) -> list[str]:
        return [self.digests[parent] for parent, _ in reversed(self._descend(root, place))]


def leaves(docs: DataFrame, fields: Sequence[str], key: str, group: str, changed: Mapping[str, Column] | None = None,
           when: Column | None = None) -> DataFrame:
    """Per row: key, seq (the group as text that sorts null first), leaf, altered (its leaf with the
    ``changed`` fields where ``when`` holds, else null)."""
    def one(values: Mapping[str, Column]) -> Column:
        parts = []
        for name in fields:
            value = values.get(name, F.col(f"`{name}`")).cast("string")
            parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
        return F.sha2(F.concat(*parts), 256)

    altered = F.when(when, one(changed)) if changed is not None and when is not None else F.lit(None).cast("string")
    seq = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))
    return docs.select(F.col(f"`{key}`").alias("key"), seq.alias("seq"), one({}).alias("leaf"), altered.alias("altered"))


def _levels(n: int, width: int, block_levels: int) -> int:
    """Levels that a block of a sequence of ``n`` nodes is folded by in one round."""
    levels, size = 0, 1
    while size < n and levels < block_levels:
        levels, size = levels + 1, size * width
    return levels


def _rounds(nodes: DataFrame, width: int, block_levels: int) -> list[DataFrame]:
    """The nodes (seq, pos, digest, n) of every round, the last with one node of each sequence."""
    spark, size = nodes.sparkSession, width ** block_levels
    schema = arrow_schema(spark, _NODES)

    def fold(key, table):
        table = table.sort_by("pos")
        n = table["n"][0].as_py()
        tree = PersistentTree(table["digest"].to_pylist(), _levels(n, width, block_levels), width)
        return pa.Table.from_pydict({"seq": [key[0].as_py()], "pos": [key[1].as_py()], "digest": [tree.digests[tree.root]],
                                     "n": [-(-n // size)]}, schema=schema)

    rounds, most = [nodes], nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        blocks = rounds[-1]
        if "block" not in blocks.columns:
            blocks = blocks.withColumn("block", F.floor(F.col("pos") / size))
        rounds.append(materialise(blocks.groupBy("seq", "block").applyInArrow(fold, _NODES), "merkle-round"))
        most = math.ceil(most / size)
    return rounds


def _numbered(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` with pos (from 0 within seq), written.

    A row number of the scan ends the order, so a crowd of equal rows is spread over slices too."""
    ranked = rank_within_groups(df.withColumn("tie", F.monotonically_increasing_id()), ["seq"], [*order, F.col("tie")])
    return materialise(ranked.withColumn("pos", F.col("rank") - 1).drop("rank", "tie"), "merkle-leaves")


def _sized(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` with block and n (rows of seq). The count meets a row per block first and the rows by
    block: by group alone, one task would hold a whole group."""
    rows = rows.withColumn("block", F.floor(F.col("pos") / size))
    totals = rows.groupBy("seq").agg((F.max("pos") + 1).alias("n"))
    counts = rows.select("seq", "block").distinct().join(totals, "seq")
    return rows.join(counts, ["seq", "block"])


@dataclass
class Manifest:
    """The tree of every group and that of the subroots, round by round."""

    rows_in: DataFrame          # key, seq, leaf, altered, pos, n
    rounds: list[DataFrame]     # nodes of the groups' trees
    tops: list[DataFrame]       # nodes of the tree over the subroots
    names: DataFrame            # seq, pos of its subroot in the upper tree
    width: int
    block_levels: int

    def subroots(self) -> DataFrame:
        return self.rounds[-1].select("seq", F.col("digest").alias("subroot"))

    def root(self) -> DataFrame:
        return self.tops[-1].select(F.col("digest").alias("root"))

    def _handed_down(self, nodes: DataFrame, above: DataFrame) -> DataFrame:
        """Paths of ``nodes`` from those of their blocks: seq, pos, path, subroot, root."""
        width, block_levels = self.width, self.block_levels
        schema = arrow_schema(nodes.sparkSession, spec := f"seq string, pos long, path {_PATH}, subroot string, root string")

        def hand(key, left, right):
            left = left.sort_by("pos")
            tree = PersistentTree(left["digest"].to_pylist(), _levels(left["n"][0].as_py(), width, block_levels), width)
            upper = right["path"][0].as_py()
            count = left.num_rows
            return pa.Table.from_pydict({
                "seq": left["seq"], "pos": left["pos"], "path": [tree.path(tree.root, k) + upper for k in range(count)],
                "subroot": right["subroot"].to_pylist() * count, "root": right["root"].to_pylist() * count}, schema=schema)

        return materialise(self._by_block(nodes).cogroup(self._as_block(above)).applyInArrow(hand, spec), "merkle-paths")

    def _by_block(self, nodes: DataFrame):
        if "block" not in nodes.columns:
            nodes = nodes.withColumn("block", F.floor(F.col("pos") / self.width ** self.block_levels))
        return nodes.groupBy("seq", "block")

    def _as_block(self, above: DataFrame):
        return above.withColumnRenamed("pos", "block").groupBy("seq", "block")

    def rows(self) -> DataFrame:
        """Per leaf: key, leaf, subroot, root, path (struct before, after per level, lowest first), and of a changed leaf
        altered, version_root and copied (the digests of the nodes that its version does not share)."""
        none = F.lit(None).cast("string")
        paths = self.tops[-1].select("seq", "pos", F.array().cast(_PATH).alias("path"), none.alias("subroot"), F.col("digest").alias("root"))
        for nodes in reversed(self.tops[:-1]):
            paths = self._handed_down(nodes, paths)
        paths = (self.names.join(paths.select("pos", "path", "root"), "pos").drop("pos").join(self.subroots(), "seq")
                 .select("seq", F.lit(0).cast("long").alias("pos"), "path", "subroot", "root"))
        for nodes in reversed(self.rounds[1:-1]):
            paths = self._handed_down(nodes, paths)

        width, block_levels = self.width, self.block_levels
        kind = self.rows_in.schema["key"].dataType.simpleString()
        spec = (f"key {kind}, leaf string, altered string, subroot string, root string, path {_PATH}, "
                "version_root string, copied array<string>")
        schema = arrow_schema(self.rows_in.sparkSession, spec)

        def emit(key, left, right):
            left = left.sort_by("pos")
            tree = PersistentTree(left["leaf"].to_pylist(), _levels(left["n"][0].as_py(), width, block_levels), width)
            upper = right["path"][0].as_py()
            copied = []
            for place, leaf in enumerate(left["altered"].to_pylist()):
                if leaf is None:
                    copied.append(None)
                    continue
                version = tree.changed(tree.root, place, leaf)
                own = [leaf, *tree.ancestors(version, place)]
                for step in upper:  # the copies above the block
                    own.append(digest(step["before"], own[-1], step["after"]))
                copied.append(own)
            count = left.num_rows
            return pa.table([left["key"], left["leaf"], left["altered"],
                             pa.array(right["subroot"].to_pylist() * count, pa.string()),
                             pa.array(right["root"].to_pylist() * count, pa.string()),
                             pa.array([tree.path(tree.root, k) + upper for k in range(count)], schema.field("path").type),
                             pa.array([c and c[-1] for c in copied], pa.string()),
                             pa.array([c and c[1:] for c in copied], pa.list_(pa.string()))], schema=schema)

        return self._by_block(self.rows_in).cogroup(self._as_block(paths)).applyInArrow(emit, spec)


def build(leaf_rows: DataFrame, width: int = WIDTH, block_levels: int = BLOCK_LEVELS) -> Manifest:
    """The manifest of a table of ``leaves``."""
    size = width ** block_levels
    rows = _sized(_numbered(leaf_rows, [F.col("key").asc(), F.col("leaf").asc()]), size)
    rounds = _rounds(rows.select("seq", "pos", F.col("leaf").alias("digest"), "n", "block"), width, block_levels)
    tops = _numbered(rounds[-1].select(F.lit("").alias("seq"), "digest", F.col("seq").alias("name")), [F.col("name").asc()])
    nodes = _sized(tops, size).select("seq", "pos", "digest", "n")
    return Manifest(rows, rounds, _rounds(nodes, width, block_levels), tops.select(F.col("name").alias("seq"), "pos"), width, block_levels)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with its siblings: the check of a proof."""
    return F.aggregate(path, leaf, lambda d, s: F.sha2(F.concat(s["before"], d, s["after"]), 256))


__all__ = ["BLOCK_LEVELS", "Manifest", "PersistentTree", "build", "digest", "folded", "leaves"]
