"""Embedding near-duplicates by a random-projection tree forest.

Each of ``n_trees`` trees splits unit vectors recursively by random directions at the median of
a bounded sample; a vector within ``spill`` of the split goes to both sides. For a pair at
cosine 0.93 in 64 dimensions a split parts the two with probability about 0.03, so eight trees
miss it with probability 1e-6 three levels deep and 1e-4 eleven levels deep (billions of
vectors); closer pairs are missed far less. Leaves are made
per label (links need equal labels). The first trees are fitted on a sample of at most
``sample_rows`` distinct vectors (a parameter; samples only place the split points), and
all vectors are indexed. Leaves that are too large are split on by trees fitted on samples of their own, in
rounds, so the size of a leaf does not grow with the table. Vectors meet in a leaf, are compared there in double precision, and
links are united. Equal vectors of one label are one class with a count throughout, so copies
cost nothing and lose nothing.

A split is made only where it pays: the vectors that go to both sides must be less than
``OVERLAP`` of the smaller side. Where no tried direction and cut does, the node stays one leaf,
so a dense cluster costs one entry per vector and tree and not a tree of copies.

A leaf can hold a third of all vectors (one dense cluster cannot be split without losing
links). Its vectors are dealt into blocks by hash, and a task compares one pair of blocks, so
memory is bounded and no pair is emitted: a task returns, per vector, how many rows it links
to, and a spanning forest of the links it found. A pair that meets in several leaves counts
in one of them only, the first that the two have in common, which every task can tell from
the leaf lists that travel with the vectors.

Defined results: a vector that is null, empty, zero, or holds null or non-finite components,
or whose label is null, has no links and is its own component; vectors of different lengths
never link; repeated vec_ids are separate vectors that share the id (their component is the
smallest id reached by any); a null vec_id is kept as a row of its own with null component
and kept true; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segrec.llm.common import materialise, pick
from segrec.llm.components import connected_components
from segrec.llm.hashing import mix

LEAF = 2048     # a node of at most so many vectors (in proportion: of the sample) is not split further
BLOCK = 4096    # vectors of a leaf in one block
OVERLAP = 0.45  # share of a split's smaller side that may be on both sides
CUTS = (0.5, 0.5, 0.3, 0.7, 0.15, 0.85, 0.5, 0.3, 0.7, 0.15, 0.85)  # tried in turn, each along a new direction
DEEPEN = 2      # leaves of more than so many times the wanted size are split on
LEAF_SAMPLE = 4096  # vectors of such a leaf that its own tree is fitted on, and that one task places, about
TILE = 1024     # side of the dot-product tiles within a block pair


class Tree:
    """Split points of one tree: nodes (direction seed is the node's place, threshold, children)."""

    def __init__(self, sample: np.ndarray, rng: np.random.Generator, leaf: int, spill: float):
        self.nodes: list[tuple[np.ndarray, float, int, int] | None] = []
        self.leaf, self.spill = leaf, spill
        self._grow(sample, rng)

    def _grow(self, rows: np.ndarray, rng: np.random.Generator) -> int:
        place = len(self.nodes)
        self.nodes.append(None)
        for share in CUTS if len(rows) > self.leaf else ():
            direction = rng.standard_normal(rows.shape[1])
            direction /= np.linalg.norm(direction)
            along = rows @ direction
            cut = float(np.quantile(along, share))
            left, right = along <= cut + self.spill, along >= cut - self.spill
            n_left, n_right = int(left.sum()), int(right.sum())
            # a split that keeps nearly everything on one side or much on both separates little
            if max(n_left, n_right) <= 0.9 * len(rows) and n_left + n_right - len(rows) <= OVERLAP * min(n_left, n_right):
                children = self._grow(rows[left], rng), self._grow(rows[right], rng)
                self.nodes[place] = (direction, cut, *children)
                break
        return place

    def leaves(self, rows: np.ndarray) -> list[list[int]]:
        """The leaves of each row."""
        out: list[list[int]] = [[] for _ in range(len(rows))]
        stack = [(0, np.arange(len(rows)))]
        while stack:
            place, index = stack.pop()
            if self.nodes[place] is None:
                for i in index:
                    out[i].append(place)
                continue
            direction, cut, left, right = self.nodes[place]
            along = rows[index] @ direction
            if (below := index[along <= cut + self.spill]).size:
                stack.append((left, below))
            if (above := index[along >= cut - self.spill]).size:
                stack.append((right, above))
        return out


def fit_forest(sample: dict[int, np.ndarray], n_trees: int, leaf: int, spill: float, seed: int) -> dict:
    """label, length -> trees, from the sample's unit vectors."""
    out = {}
    for key, rows in sample.items():
        trees = [Tree(rows, np.random.default_rng([seed, *(x % 2**32 for x in key), t]), leaf, spill) for t in range(n_trees)]
        # where a tree is a single leaf all pairs meet in it, and no other tree is needed
        whole = [t for t in trees if t.nodes[0] is None]
        out[key] = whole[:1] or trees
    return out


def _units(vectors) -> np.ndarray:
    rows = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _usable(column: str):
    """Valid vectors: all components finite, not all zero."""
    v = F.col(column)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _compare_blocks(threshold: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        """One leaf, one pair of blocks: link counts and a spanning forest of the links."""
        here, first, second = (group[c].iloc[0] for c in ("place", "first", "second"))
        ids, weight, block = (group[c].to_numpy() for c in ("class_id", "n", "block"))
        rows = _units(group["v"])
        # a pair counts in the first leaf that the two share: earlier leaves as columns of ones
        earlier = {p: k for k, p in enumerate(sorted({p for places in group["places"] for p in places if p < here}))}
        met = np.zeros((len(ids), len(earlier)), dtype=np.float32)
        for i, places in enumerate(group["places"]):
            met[i, [earlier[p] for p in places if p < here]] = 1
        left, right = np.flatnonzero(block == first), np.flatnonzero(block == second)
        counts, label = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
        edges = []
        for i in range(0, len(left), TILE):
            for j in range(i if first == second else 0, len(right), TILE):
                a, b = left[i:i + TILE], right[j:j + TILE]
                close = rows[a] @ rows[b].T >= threshold
                if first == second and i == j:
                    close &= np.triu(np.ones(close.shape, dtype=bool), 1)
                if not close.any():
                    continue
                if len(earlier):
                    close &= met[a] @ met[b].T == 0
                counts[a] += close @ weight[b]
                counts[b] += weight[a] @ close
                for k in np.flatnonzero(close.any(axis=1)):
                    others = b[close[k]]
                    _, one = np.unique(label[others], return_index=True)
                    for other in others[one]:  # one link to each component not joined before
                        if (p := label[a[k]]) != (q := label[other]):
                            label[label == max(p, q)] = min(p, q)
                            edges.append((ids[a[k]], ids[other]))
        linked = np.flatnonzero(counts)
        return pd.DataFrame({"class_id": np.concatenate([ids[linked], [e[0] for e in edges]]).astype(np.int64),
                             "other": pd.array([None] * len(linked) + [int(e[1]) for e in edges], dtype="Int64"),
                             "links": np.concatenate([counts[linked], np.zeros(len(edges), np.int64)]).astype(np.int64)})

    return run


def place_vectors(classes: DataFrame, n_trees: int, spill: float, leaf: int, sample_rows: int, seed: int) -> DataFrame:
    """class_id, label, n, v and places: the leaves of every vector, over all trees."""
    total = classes.count()

    sampled = classes.select("label", "v")
    if total > sample_rows:
        sampled = sampled.orderBy(F.xxhash64("v", F.lit(seed))).limit(sample_rows)
    by_label: dict[tuple[int, int], list] = {}
    for r in sampled.collect():  # at most sample_rows vectors
        by_label.setdefault((r["label"], len(r["v"])), []).append(r["v"])
    # The sample stands for all vectors: a leaf of `leaf` vectors holds leaf * sample / total of it.
    share = min(1.0, sample_rows / max(1, total))
    forest = fit_forest({k: _units(v) for k, v in by_label.items()}, n_trees, max(8, int(leaf * share)), spill, seed)
    shared = classes.sparkSession.sparkContext.broadcast(forest)  # bounded by sample_rows and n_trees

    def place(batches):
        for batch in batches:
            out = [[] for _ in range(len(batch))]
            keys = [(int(label), len(v)) for label, v in zip(batch["label"], batch["v"], strict=True)]
            for key in set(keys):
                index = [i for i, k in enumerate(keys) if k == key]
                units = _units([batch["v"].iloc[i] for i in index])
                for t, tree in enumerate(shared.value.get(key, [])):
                    for i, leaves in zip(index, tree.leaves(units), strict=True):
                        out[i] += [t << 32 | x for x in sorted(leaves)]
                if key not in shared.value:  # a label without a sample: one leaf
                    for i in index:
                        out[i] = [0]
            yield batch.assign(places=out)

    vector = classes.schema["v"].dataType.simpleString()
    placed = classes.select("class_id", "label", "n", "v").mapInPandas(
        place, f"class_id long, label long, n long, v {vector}, places array<long>")
    return _deepened(materialise(placed, "vector-leaves"), leaf, spill, seed)


def _deepened(placed: DataFrame, leaf: int, spill: float, seed: int) -> DataFrame:
    """``placed`` with leaves of more than ``DEEPEN * leaf`` vectors split on, by trees of their own.

    A tree of a sample can be no deeper than the sample, so its leaves grow with the table. Such a
    leaf is split by a tree that is fitted on a sample of the leaf itself (``LEAF_SAMPLE`` vectors, chosen by
    hash), and so on until every leaf is small or no split of it pays. Fitting is one task
    per leaf over its sample; placing is dealt over ``(leaf, part)``, so no task holds a whole large leaf."""
    where = ["label", "length", "place"]
    vectors = placed.select("class_id", "label", "n", "v")
    entries, rounds = placed.select("class_id", "label", F.size("v").alias("length"), F.explode("places").alias("place"),
                                    F.lit(False).alias("settled")), 0
    schema = vectors.schema["v"].dataType.simpleString()

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        key = [int(group[c].iloc[0]) for c in where]
        size, rows = int(group["size"].iloc[0]), _units(group["v"])
        tree = Tree(rows, np.random.default_rng([seed, rounds, *(x % 2**32 for x in key)]), max(8, leaf * len(rows) // size), spill)
        return pd.DataFrame({**{c: [k] for c, k in zip(where, key, strict=True)},
                             "tree": [pickle.dumps(tree) if tree.nodes[0] is not None else None], "parts": [1 + size // LEAF_SAMPLE]})

    def deal(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({c: [] for c in ("class_id", *where)}, dtype="int64")
        found = pickle.loads(right["tree"].iloc[0]).leaves(_units(left["v"]))
        counts = [len(x) for x in found]
        below = np.array([y for x in found for y in x], dtype=np.uint64)
        # a leaf of the new tree is named by its parent's name and its own, mixed
        name = mix(np.uint64(int(left["place"].iloc[0]) % 2**64) ^ mix(below + np.uint64(1))).view(np.int64)
        return pd.DataFrame({"class_id": np.repeat(left["class_id"].to_numpy(), counts), "label": left["label"].iloc[0],
                             "length": left["length"].iloc[0], "place": name})

    while True:
        large = materialise(entries.where("not settled").groupBy(*where).agg(F.count(F.lit(1)).alias("size"))
                            .where(F.col("size") > DEEPEN * leaf), "large-leaves")
        if not large.head(1):
            break
        chosen = F.pmod(F.xxhash64("class_id", "place", F.lit(seed + rounds)), F.lit(1 << 30)) < LEAF_SAMPLE / F.col("size") * (1 << 30)
        sample = entries.join(large, where).where(chosen).join(vectors.select("class_id", "v"), "class_id")
        trees = materialise(sample.select(*where, "size", "v").groupBy(*where).applyInPandas(
            fit, "label long, length int, place long, tree binary, parts int"), "leaf-trees")
        split = trees.where("tree is not null")
        marked = entries.join(trees.select(*where, F.col("tree").isNotNull().alias("goes"), "parts"), where, "left")
        stays = marked.where("not coalesce(goes, false)").select("class_id", *where, (F.col("settled") | F.col("goes").isNotNull()).alias("settled"))
        moved = (marked.where("goes").withColumn("part", F.pmod(F.xxhash64("class_id"), F.col("parts")).cast("int"))
                 .join(vectors.select("class_id", "v"), "class_id"))
        copies = split.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(*where, "part", "tree")
        new = (moved.select("class_id", *where, "part", "v").groupBy(*where, "part").cogroup(copies.groupBy(*where, "part"))
               .applyInPandas(deal, "class_id long, label long, length int, place long").withColumn("settled", F.lit(False)))
        entries, rounds = materialise(stays.unionByName(new), "deeper-leaves"), rounds + 1
    if not rounds:
        return placed
    places = entries.groupBy("class_id").agg(F.collect_set("place").alias("places"))  # some per tree
    return materialise(vectors.join(places, "class_id").select("class_id", "label", "n", F.col("v").cast(schema).alias("v"), "places"), "vector-leaves")


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, n_trees: int = 8, spill: float = 0.02,
                    leaf: int = LEAF, sample_rows: int = 50_000, seed: int = 17, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows = pick(vectors, vec_id=id_col, v=vector_col, label=label_col)
    rows = rows.withColumn("label", F.col("label").cast("long"))
    rows = rows.withColumn("valid", _usable("v") & F.col("label").isNotNull())
    # -0.0 and 0.0 are one value; a class is one label and one vector, kept in the input's type
    rows = rows.withColumn("v", F.when(F.col("valid"), F.transform("v", lambda x: F.when(x == 0, F.abs(x)).otherwise(x))))
    rows = rows.withColumn("class_key", F.when(F.col("valid"), F.sha2(F.to_json(F.struct("label", "v")), 256)))
    rows = materialise(rows, "vectors")
    classes = (rows.where("valid").groupBy("class_key").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least_id"),
                                                            F.first("v").alias("v"), F.first("label").alias("label")))
    classes = materialise(classes.withColumn("class_id", F.monotonically_increasing_id()), "vector-classes")
    placed = place_vectors(classes, n_trees, spill, leaf, sample_rows, seed)
    entries = placed.withColumn("place", F.explode("places"))
    sizes = (entries.groupBy("label", F.size("v").alias("length"), "place").agg(F.count(F.lit(1)).alias("size"))
             .where("size > 1").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")))
    keyed = entries.withColumn("length", F.size("v")).join(sizes, ["label", "length", "place"])
    keyed = keyed.withColumn("block", F.pmod(F.xxhash64("class_id", "place"), F.col("blocks")).cast("int"))
    # a vector of block i meets the blocks before and after it
    paired = keyed.withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "label", "length", "place",
        F.least("block", "mate").alias("first"), F.greatest("block", "mate").alias("second"),
        "block", "class_id", "n", "v", "places")
    found = paired.groupBy("label", "length", "place", "first", "second").applyInPandas(
        _compare_blocks(threshold), "class_id long, other long, links long")
    found = materialise(found, "vector-links")

    links = found.where("links > 0").groupBy("class_id").agg(F.sum("links").alias("links"))
    joined = connected_components(classes.select(F.col("class_id").alias("node")),
                                  found.where("other is not null").select(F.col("class_id").alias("a"), F.col("other").alias("b")))
    named = classes.join(joined.withColumnRenamed("node", "class_id"), "class_id")
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = (named.join(least, "component").join(links, "class_id", "left")
             .select("class_key", "n", F.coalesce("links", F.lit(0)).alias("links"), "component_id"))
    out = rows.select("vec_id", "class_key").join(named, "class_key", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce(F.col("links") + F.col("n") - 1, F.lit(0)).cast("long").alias("n_links"),
                      component.cast("long").alias("component_id"),
                      F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


__all__ = ["Tree", "fit_forest", "near_duplicates"]
