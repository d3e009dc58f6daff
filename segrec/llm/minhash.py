"""MinHash near-duplicates with b-bit signatures.

Texts are written once as chunks, bucketed by chunk, and read from there: no step shuffles text.

1. Per text: the set of word shingles (64-bit hashes), ``hashes`` minima, the keys of the
   ``bands`` (from full minima) and a signature of the low ``bits`` bits of every minimum,
   packed into bit planes. Texts with equal sets are one class from here on.
2. Texts that share a band key are candidates. First each class against the smallest class of
   its bucket only, so a bucket of n classes gives n - 1 candidates. Candidates pass if the
   similarity estimated from the signatures by bit counts, corrected for chance collisions of
   the low bits, is within ``slack`` standard errors of the threshold; what passes is verified
   on the full sets, made again for those texts alone in the tasks of their chunks, and links are united.
3. What is left are buckets whose classes lie in several components. Their classes, with their
   full sets, are dealt into blocks of bounded bytes by hash. A task compares one pair of
   blocks by bit counts, verifies what passes the estimate and joins components not yet joined
   (each pair in the first bucket that its classes share), and returns only the links that did
   join: no pair is emitted for not being one. Afterwards every two classes of a bucket are in
   one component or were compared, so no candidate is lost, and no group is held by one task.

With 32 bands of 4 minima a pair of similarity 0.8 shares no band with probability 5e-8; the
estimate misses one with probability 4e-10 (binomial; ``slack`` = 7 standard errors). No link below
the threshold is made.

Defined results: null text, or text without words, has an empty set and links with nothing;
rows with a null id link with nothing either, component null, kept true; repeated ids are
separate rows that share the id; an empty table gives an empty result; extra columns are
ignored. Texts of any length are hashed whole, minima in slices of bounded size.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segrec.llm.common import chunk_table, map_rows, materialise, pick
from segrec.llm.components import connected_components
from segrec.llm.hashing import Windows, mix, shingle_set, word_hashes

BLOCK = 2048           # classes of one block of a bucket, at most about so many
BLOCK_SHINGLES = 1 << 20  # and shingles in their sets
SLICE = 4096


class Signer:
    """Minima, band keys and bit planes of a shingle set."""

    def __init__(self, hashes: int, bands: int, bits: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.factor = rng.integers(0, 2**31, hashes, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.flip = rng.integers(0, 2**32, hashes, dtype=np.uint32)
        self.hashes, self.bands, self.bits = hashes, bands, bits
        self.rows = hashes // bands

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        low = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
        best = np.full(self.hashes, 2**32 - 1, dtype=np.uint32)
        for at in range(0, len(low), SLICE):
            part = (low[at:at + SLICE, None] ^ self.flip) * self.factor
            np.minimum(best, part.min(axis=0), out=best)
        return best

    def band_keys(self, minima: np.ndarray) -> list[int]:
        keys = mix(np.arange(1, self.bands + 1, dtype=np.uint64))
        for row in minima[:self.bands * self.rows].reshape(self.bands, self.rows).T:
            keys = mix(keys ^ row)
        return keys.view(np.int64).tolist()

    def planes(self, minima: np.ndarray) -> list[int]:
        """For each of the low bits, the bits of all minima in longs."""
        return np.concatenate([np.packbits((minima >> np.uint32(b)) & np.uint32(1)).view(">i8")
                               for b in range(self.bits)]).tolist()


def least_matches(threshold: float, hashes: int, bits: int, slack: float) -> int:
    """Matching low-bit groups that a pair at the threshold has but for ``slack`` standard errors.

    E[matches] = hashes * (C + (1 - C) * J) with the chance collision C = 2^-bits."""
    chance = 2.0 ** -bits
    p = chance + (1 - chance) * threshold
    return math.ceil(hashes * p - slack * math.sqrt(hashes * p * (1 - p)))


def matches(a: Column, b: Column, hashes: int, bits: int) -> Column:
    """Equal low-bit groups of two signatures (arrays of bit planes)."""
    words = hashes // 64
    out = F.lit(hashes)
    for w in range(words):
        differ = a[w].bitwiseXOR(b[w])
        for plane in range(1, bits):
            differ = differ.bitwiseOR(a[plane * words + w].bitwiseXOR(b[plane * words + w]))
        out = out - F.bit_count(differ)
    return out


def similarity_estimate(a: Column, b: Column, hashes: int, bits: int) -> Column:
    """Collision-corrected Jaccard similarity from two signatures."""
    chance = 2.0 ** -bits
    return (matches(a, b, hashes, bits) / F.lit(hashes) - F.lit(chance)) / F.lit(1 - chance)


def _lower_words(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def _features(chunks: DataFrame, shingle: int, signer: Signer) -> DataFrame:
    def work(batches):
        windows = Windows(shingle)
        for b in batches:
            out = {"chunk": b["chunk"], "nth": b["nth"], "doc_id": b["doc_id"], "n_shingles": [], "set_key": [], "signature": [], "bands": []}
            for doc_id, text in zip(b["doc_id"], b["text"], strict=True):
                shingles = shingle_set(word_hashes(_lower_words(text)), windows)
                out["n_shingles"].append(len(shingles))
                if not len(shingles) or doc_id is None:
                    for k in ("set_key", "signature", "bands"):
                        out[k].append(None)
                    continue
                minima = signer.minima(shingles)
                out["set_key"].append(_set_key(shingles))
                out["signature"].append(signer.planes(minima))
                out["bands"].append(signer.band_keys(minima))
            yield out

    return map_rows(chunks, "chunk long, nth long, doc_id long, n_shingles long, set_key binary, signature array<long>, bands array<long>", work)


def _set_key(shingles: np.ndarray) -> bytes:
    import hashlib

    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    a = sets.select(F.col("class_id").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("class_id").alias("b"), F.col("shingles").alias("sb"))

    def work(batches):
        for c in batches:
            keep = [i for i, (x, y) in enumerate(zip(c["sa"], c["sb"], strict=True))
                    if _linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)]
            yield {"a": [c["a"][i] for i in keep], "b": [c["b"][i] for i in keep]}

    return map_rows(pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb"), "a long, b long", work)


def _compare_blocks(least: int, hashes: int, bits: int, percent: int):
    words = hashes // 64

    def run(group: pd.DataFrame) -> pd.DataFrame:
        """One bucket, one pair of blocks: links that join components not joined before."""
        here, first, second = (group[c].iloc[0] for c in ("key", "first", "second"))
        block = group["block"].to_numpy()
        planes = np.stack(group["signature"].to_numpy()).astype(np.int64).view(np.uint64)
        ids, size = group["class_id"].to_numpy(), group["n"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in group["shingles"]]
        keys = [frozenset(x.tolist()) for x in group["keys"]]
        _, component = np.unique(group["component"].to_numpy(), return_inverse=True)
        parent = np.arange(component.max() + 1)

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        left, right = np.flatnonzero(block == first), np.flatnonzero(block == second)
        links = []
        for i in left:
            others = right[(component[right] != component[i]) & ((ids[right] > ids[i]) | (first != second))]
            small, big = np.minimum(size[others], size[i]), np.maximum(size[others], size[i])
            others = others[100 * small >= percent * big]
            if not len(others):
                continue
            differ = np.bitwise_or.reduce((planes[others] ^ planes[i]).reshape(-1, bits, words), axis=1)
            same = hashes - np.bitwise_count(differ).sum(axis=1, dtype=np.int64)
            for j in others[same >= least]:
                p, q = root(component[i]), root(component[j])
                if p != q and min(keys[i] & keys[j]) == here and _linked(sets[i], sets[j], percent):
                    parent[max(p, q)] = min(p, q)
                    links.append((ids[i], ids[j]))
        a, b = np.array(links, dtype=np.int64).reshape(-1, 2).T
        return pd.DataFrame({"a": np.maximum(a, b), "b": np.minimum(a, b)})

    return run


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, hashes: int = 128, bands: int = 32,
                    bits: int = 2, slack: float = 7.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    # written once by chunk: full sets are made again where the texts lie, without a shuffle of text
    chunks, _ = chunk_table(rows)
    return grouped_rows(chunks, F.col("row.doc_id"), shingle, percent, hashes, bands, bits, slack).drop("chunk", "nth")


def grouped_rows(chunks: DataFrame, row_id: Column, shingle: int = 5, percent: int = 80, hashes: int = 128, bands: int = 32,
                 bits: int = 2, slack: float = 7.0) -> DataFrame:
    """``near_duplicates`` of a ``chunk_table``, whose rows are named by ``row_id`` (long), with their chunk and nth."""
    signer = Signer(hashes, bands, bits)
    least = least_matches(percent / 100, hashes, bits, slack)
    features = materialise(_features(chunks.select("chunk", "nth", row_id.alias("doc_id"), "text"), shingle, signer), "minhash-features")
    classes = (features.where("set_key is not null").groupBy("set_key")
               .agg(F.min(F.struct("doc_id", "chunk", "nth")).alias("least"), F.first("n_shingles").alias("n"),
                    F.first("signature").alias("signature"), F.first("bands").alias("bands"))
               .select("set_key", F.col("least.doc_id").alias("least_id"), F.struct("least.chunk", "least.nth").alias("place"), "n", "signature", "bands")
               .withColumn("class_id", F.monotonically_increasing_id()))
    classes = materialise(classes, "minhash-classes")
    members = classes.select("class_id", F.explode("bands").alias("key"))
    signed = classes.select("class_id", "n", "signature")

    # 2. every class against the smallest of its bucket
    hubs = members.groupBy("key").agg(F.min("class_id").alias("b"), F.count(F.lit(1)).alias("size")).where("size > 1")
    hubs = materialise(hubs, "minhash-buckets")
    star = (members.join(hubs.select("key", "b"), "key").where("class_id != b")
            .select(F.col("class_id").alias("a"), "b").distinct())
    sa = signed.select(F.col("class_id").alias("a"), F.col("n").alias("na"), F.col("signature").alias("ga"))
    sb = signed.select(F.col("class_id").alias("b"), F.col("n").alias("nb"), F.col("signature").alias("gb"))
    near = (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")) & (
        matches(F.col("ga"), F.col("gb"), hashes, bits) >= least)
    star = materialise(star.join(sa, "a").join(sb, "b").where(near).select("a", "b"), "minhash-star")
    met = star.select(F.col("a").alias("class_id")).unionByName(star.select(F.col("b").alias("class_id"))).distinct()
    sets = _full_sets(chunks, classes, met, shingle)
    links = materialise(_verified(star, sets, percent), "minhash-links")
    component = materialise(connected_components(classes.select(F.col("class_id").alias("node")), links), "minhash-components")

    # 3. buckets that still hold several components
    crowded = members.join(hubs.select("key"), "key").join(component.withColumnRenamed("node", "class_id"), "class_id")
    mixed = (crowded.join(signed.select("class_id", "n"), "class_id")
             .groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                 F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"))
             .where("low != high and size > 2")
             .select("key", F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
                     .cast("int").alias("blocks")))
    crowded = materialise(crowded.join(mixed, "key"), "minhash-crowded")
    keys = crowded.groupBy("class_id").agg(F.collect_set("key").alias("keys"))  # at most one per band
    sets = _full_sets(chunks, classes, crowded.select("class_id").distinct(), shingle)
    dealt = (crowded.join(signed.join(keys, "class_id").join(sets, "class_id"), "class_id")
             .withColumn("block", F.pmod(F.xxhash64("class_id", "key"), F.col("blocks")).cast("int"))
             .withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.least("block", "mate").alias("first"), F.greatest("block", "mate").alias("second"),
                     "block", "class_id", "component", "n", "signature", "keys", "shingles"))
    more = materialise(dealt.groupBy("key", "first", "second").applyInPandas(
        _compare_blocks(least, hashes, bits, percent), "a long, b long"), "minhash-more")
    component = connected_components(classes.select(F.col("class_id").alias("node")), links.unionByName(more))

    named = classes.select("class_id", "set_key", "least_id").join(component.withColumnRenamed("node", "class_id"), "class_id")
    ids = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = named.join(ids, "component").select("set_key", "component_id")
    out = features.select("chunk", "nth", "doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
    found = F.coalesce("component_id", "doc_id")
    return out.select("chunk", "nth", "doc_id", "n_shingles", found.alias("component_id"),
                      F.coalesce(found == F.col("doc_id"), F.lit(True)).alias("kept"))


def _full_sets(chunks: DataFrame, classes: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """class_id and full shingle set of the wanted classes, from one text of each."""
    wanted = classes.select("class_id", "place.chunk", "place.nth").join(wanted, "class_id")

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, sets = [], []
        if left.num_rows:
            nth = right["nth"].to_numpy()
            order = np.argsort(nth)
            windows = Windows(shingle)
            places = order[np.searchsorted(nth[order], left["nth"].to_numpy())].tolist()
            for class_id, place in zip(left["class_id"].to_pylist(), places, strict=True):
                ids.append(class_id)
                sets.append(shingle_set(word_hashes(_lower_words(right["text"][place].as_py())), windows).tobytes())
        return pa.table([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], names=["class_id", "shingles"])

    found = wanted.groupBy("chunk").cogroup(chunks.select("chunk", "nth", "text").groupBy("chunk")).applyInArrow(
        work, "class_id long, shingles binary")
    return materialise(found, "minhash-sets")


__all__ = ["Signer", "grouped_rows", "least_matches", "matches", "near_duplicates", "similarity_estimate"]
