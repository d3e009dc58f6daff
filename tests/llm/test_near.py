import inspect
import math
import random
from collections import Counter

import brute_llm as brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from segrec.llm import minhash, rpforest
from segrec.llm.components import connected_components
from segrec.llm.queries import op7_minhash_dedup, op9_embedding_dedup


def documents():
    rng = random.Random(7)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(300))
    docs, base = [], [[word() for _ in range(rng.choice([8, 40, 120, 400]))] for _ in range(12)]
    for i in range(160):  # edits around the threshold, so groups hold links and near misses
        w = list(rng.choice(base))
        for _ in range(rng.randrange(0, max(2, len(w) // 25) + 1)):
            w[rng.randrange(len(w))] = word()
        docs.append((i, " ".join(w)))
    docs += [(500 + i, docs[i % 3][1]) for i in range(40)]  # exact copies
    docs += [(600, None), (601, ""), (602, " \n"), (603, "One two"), (604, "one TWO"), (605, "one two three"),
             (606, " ".join(word() for _ in range(20_000)))]
    return docs


@pytest.mark.parametrize("block", [2048, 16])
def test_minhash_matches_all_pairs(frame, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    docs = documents()
    df = frame([(*d, "c", [1]) for d in docs], "doc_id long, text string, set_key string, bands array<int>")
    got = minhash.near_duplicates(df, shingle=4).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute.near(docs, 4)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_links_beyond_the_hub_are_found(frame):
    # a chain: neighbours are near, ends are not, whichever document is the smallest of a bucket
    words = [f"w{i}" for i in range(100)]
    docs = [(i, " ".join(words[4 * i:] + [f"x{j}" for j in range(4 * i)])) for i in (3, 0, 4, 1, 2)]
    got = minhash.near_duplicates(frame(docs, "doc_id long, text string"), shingle=2).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute.near(docs, 2)
    assert {r["component_id"] for r in got} == {0}


def test_minhash_odd_rows(frame):
    got = minhash.near_duplicates(frame([(None, "a b c d e"), (None, "a b c d e"), (3, "a b c d e"), (3, "a b c d e"), (4, None)],
                                        "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"], r["kept"]) for r in got) == [
        ("3", 1, 3, True), ("3", 1, 3, True), ("4", 0, 4, True), ("None", 1, None, True), ("None", 1, None, True)]
    assert minhash.near_duplicates(frame([], "doc_id long, text string")).count() == 0


def test_estimate_is_corrected_for_collisions(spark):
    rng = np.random.default_rng(1)
    signer = minhash.Signer(128, 32, 2)
    rows = []
    for share in (0.0, 0.5, 0.8, 1.0):
        for _ in range(30):
            common = rng.integers(0, 2**63, 400, dtype=np.uint64)
            k = int(400 * 2 * share / (1 + share))
            a, b = (np.concatenate([common[:k], rng.integers(0, 2**63, 400 - k, dtype=np.uint64)]) for _ in range(2))
            rows.append((share, signer.planes(signer.minima(a)), signer.planes(signer.minima(b))))
    df = spark.createDataFrame(rows, "share double, a array<long>, b array<long>")
    est = df.groupBy("share").agg(F.avg(minhash.similarity_estimate(F.col("a"), F.col("b"), 128, 2)).alias("e")).collect()
    assert all(abs(r["share"] - r["e"]) < 0.03 for r in est)


def test_estimate_misses_no_more_than_the_bands():
    slack = inspect.signature(minhash.near_duplicates).parameters["slack"].default
    least = minhash.least_matches(0.8, 128, 2, slack)
    assert sum(math.comb(128, k) * 0.85**k * 0.15**(128 - k) for k in range(least)) < 5e-8


def test_minhash_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in op7_minhash_dedup(spark, "/root/testdata/sf0.001").collect()}
    assert got == brute.near(docs, 4)


def test_components(frame):
    rng = random.Random(4)
    nodes = list(range(300))
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(200, 299)] + [(5, 5), (7, 8), (8, 7)]
    found = connected_components(frame([(n,) for n in nodes], "node long"), frame(edges, "a long, b long"))
    assert {r["node"]: r["component"] for r in found.collect()} == brute.components(nodes, edges)
    assert connected_components(frame([(1,)], "node long"), frame([], "a long, b long")).collect()[0]["component"] == 1


def vectors(n=400, dims=16, spread=0.12, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dims))
    rows = [(int(i), (centres[i % 12] + spread * rng.standard_normal(dims) * np.linalg.norm(centres[i % 12]) / 4).tolist(), int(i % 3 == 0))
            for i in range(n)]
    return rows + [(1000 + i, rows[i % 5][1], rows[i % 5][2]) for i in range(30)]  # exact copies


ODD = [(5000, None, 1), (5001, [0.0] * 16, 1), (5002, [float("nan")] + [1.0] * 15, 1), (5003, [None] + [1.0] * 15, 1),
       (5004, [float("inf")] + [1.0] * 15, 0), (5005, [1.0] * 16, None), (5006, [1.0] * 16, None), (5007, [], 1)]
VECTOR = "vec_id long, embedding array<double>, label int, n string, places int"


@pytest.mark.parametrize("block", [4096, 32])
def test_forest_matches_all_pairs(frame, monkeypatch, block):
    monkeypatch.setattr(rpforest, "BLOCK", block)
    rows = vectors() + ODD
    got = rpforest.near_duplicates(frame([(*r, "x", 1) for r in rows], VECTOR), leaf=20).collect()
    want = brute.cosines(rows)
    assert sum(n for n, _ in want.values()) > 1000
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_forest_fitted_on_a_small_sample(frame):
    rows = vectors(n=600)
    got = rpforest.near_duplicates(frame([(*r, "x", 1) for r in rows], VECTOR), leaf=60, sample_rows=150).collect()
    want = brute.cosines(rows)
    found, all_links = sum(r["n_links"] for r in got), sum(n for n, _ in want.values())
    assert found >= 0.99 * all_links and all(r["n_links"] <= want[r["vec_id"]][0] for r in got)


def planted(n, dims=64, seed=6):
    """Scattered vectors; every third has a near copy (cosine 0.93 and more), some have several."""
    rng = np.random.default_rng(seed)
    rows = rng.standard_normal((n, dims))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    for i in range(0, n, 3):
        for j in range(i + 1, min(i + 1 + (4 if i % 30 == 0 else 1), n)):
            aside = rng.standard_normal(dims)
            aside -= rows[i] * (aside @ rows[i])
            cosine = rng.uniform(0.931, 0.999)
            rows[j] = cosine * rows[i] + np.sqrt(1 - cosine**2) * aside / np.linalg.norm(aside)
    order = rng.permutation(n)
    return [(int(k), rows[i].tolist(), int(i % 40 == 0)) for k, i in enumerate(order)]


def test_leaves_stay_small_beyond_the_sample(spark, frame, monkeypatch):
    """A table of ten times the sample: the size of leaves is bounded and links are found."""
    monkeypatch.setattr(rpforest, "LEAF_SAMPLE", 200)
    rows = planted(4000)
    df = frame([(*r, "x", 1) for r in rows], VECTOR)
    sizes = []
    real = rpforest.place_vectors

    def watched(*args):
        out = real(*args)
        sizes.extend(r["count"] for r in out.selectExpr("label", "explode(places) AS place").groupBy("label", "place").count().collect())
        return out

    monkeypatch.setattr(rpforest, "place_vectors", watched)
    got = rpforest.near_duplicates(df, leaf=60, sample_rows=400).collect()
    want = brute.cosines(rows)
    found, all_links = sum(r["n_links"] for r in got), sum(n for n, _ in want.values())
    assert all_links > 1500 and found >= 0.99 * all_links
    assert all(r["n_links"] <= want[r["vec_id"]][0] for r in got)
    assert max(sizes) <= rpforest.DEEPEN * 60 and len(sizes) > 4000 / 60


def test_a_dense_label_ends_the_rounds(frame, monkeypatch):
    monkeypatch.setattr(rpforest, "LEAF_SAMPLE", 150)
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(dense(1200, 0.97, rng))]
    got = rpforest.near_duplicates(frame([(*r, "x", 1) for r in rows], VECTOR), leaf=50, sample_rows=200).collect()
    want = brute.cosines(rows)
    assert sum(r["n_links"] for r in got) >= 0.99 * sum(n for n, _ in want.values())


def dense(n, cosine, rng, dims=64):
    centre = rng.standard_normal(dims)
    rows = centre / np.linalg.norm(centre) + rng.standard_normal((n, dims)) * np.sqrt((1 / cosine - 1) / dims)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


@pytest.mark.parametrize("cosine", [0.95, 0.97, 0.99])
def test_a_dense_cluster_does_not_multiply(cosine):
    rng = np.random.default_rng(8)
    others = rng.standard_normal((1500, 64))
    others /= np.linalg.norm(others, axis=1, keepdims=True)
    for rows in (dense(2400, cosine, rng), np.concatenate([dense(900, cosine, rng), others])):
        tree = rpforest.Tree(rows, np.random.default_rng(2), 150, 0.02)
        leaves = tree.leaves(rows)
        assert sum(map(len, leaves)) <= 4 * len(rows)
    sizes = Counter(x for places in leaves for x in places)
    assert len(sizes) > 4  # what is not dense is split still


def test_links_of_a_dense_label(frame):
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(np.concatenate([dense(700, 0.94, rng), dense(300, 0.97, rng)]))]
    got = rpforest.near_duplicates(frame([(*r, "x", 1) for r in rows], VECTOR), leaf=100).collect()
    want = brute.cosines(rows)
    found, all_links = sum(r["n_links"] for r in got), sum(n for n, _ in want.values())
    assert found >= 0.99 * all_links and all(r["n_links"] <= want[r["vec_id"]][0] for r in got)


def test_forest_odd_rows(frame):
    v = [1.0, 2.0]
    got = rpforest.near_duplicates(frame([(1, v, 0, "", 0), (1, v, 0, "", 0), (2, [2.0, 4.0], 0, "", 0), (None, [5.0, -1.0], 0, "", 0)], VECTOR)).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], r["component_id"], r["kept"]) for r in got) == [
        ("1", 2, 1, True), ("1", 2, 1, True), ("2", 2, 1, False), ("None", 0, None, True)]
    assert rpforest.near_duplicates(frame([], VECTOR)).count() == 0


def test_forest_query(spark):
    for sf in ("sf0.001", "sf0.01"):
        rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
        got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in op9_embedding_dedup(spark, f"/root/testdata/{sf}").collect()}
        assert got == brute.cosines(rows)
