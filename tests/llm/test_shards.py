import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from segrec.llm import shards
from segrec.llm.queries import op10_sharding

SCHEMA = "doc_id long, text string, key string, part int, size string"


def best_capacity(sizes, n):
    """Smallest capacity of a greedy contiguous cut into n runs."""
    low, high = max([0, *sizes]), sum(sizes)
    while low < high:
        mid, runs, held = (low + high) // 2, 1, 0
        for s in sizes:
            if held + s > mid:
                runs, held = runs + 1, 0
            held += s
        low, high = (low, mid) if runs <= n else (mid + 1, high)
    return low


def check(rows, texts, n):
    groups = {}
    for r in rows:
        assert r["size"] == len((texts[r["doc_id"]] or "").encode()) + 1
        assert r["text_crc32"] == zlib.crc32((texts[r["doc_id"]] or "").encode())
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < n
        groups.setdefault(texts[r["doc_id"]], []).append(r)
    assert all(len({r["shard"] for r in g}) == 1 for g in groups.values())
    for s in range(n):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
    order = sorted(groups, key=lambda t: b"" if t is None else hashlib.sha256(t.encode()).digest())
    largest = max((sum(r["size"] for r in rows if r["shard"] == s) for s in range(n)), default=0)
    assert largest == best_capacity([sum(r["size"] for r in groups[t]) for t in order], n)


@pytest.mark.parametrize("n", [1, 3, 8, 200])
def test_minimax_cut(frame, n):
    rng = random.Random(9)
    texts = {i: "x" * rng.randrange(300) + "é" for i in range(120)}
    texts |= {200 + i: "copy" for i in range(90)} | {400: None, 401: None, 402: "", 403: "y" * 20_000}
    df = frame([(i, t, "clash", 1, "s") for i, t in texts.items()], SCHEMA)
    check(shards.shard_documents(df, n_shards=n).collect(), texts, n)


def test_nulls_repeats_and_empty_table(frame):
    got = shards.shard_documents(frame([(None, "a", "", 0, ""), (1, "a", "", 0, ""), (1, "a", "", 0, "")], SCHEMA), 2).collect()
    assert sorted(r["slot"] for r in got) == [0, 1, 2] and len({r["shard"] for r in got}) == 1
    assert shards.shard_documents(frame([], SCHEMA), 8).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 10**6), min_size=1, max_size=60), st.integers(1, 9), st.integers(2, 5))
def test_search_with_coarse_bins(sizes, n, bins):
    ends, at = [], 0
    for s in sizes:
        ends.append(at := at + s)

    def running_ends(_, spans, bins):
        out = {}
        for i, (low, high) in enumerate(spans):
            width = max(1, -(-(high - low) // bins))
            for e in ends:
                if low < e <= high:
                    out.setdefault((i, (e - low - 1) // width), []).append(e)
        return [(min(x), max(x), len(x)) for x in out.values()]

    original, shards._running_ends = shards._running_ends, running_ends
    try:
        capacity, cuts = shards.minimax_cuts(None, at, max(sizes), n, bins)
    finally:
        shards._running_ends = original
    assert capacity == best_capacity(sizes, n)
    assert cuts[-1] == at and set(cuts) <= {0, *ends}
    assert max(b - a for a, b in zip([0, *cuts], cuts, strict=False)) <= capacity


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    check(op10_sharding(spark, sf).collect(), texts, 8)
