import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from segrec.llm import runs


def brute_runs(words, least):
    """Every period in turn: maximal stretches of words equal to the one a period later."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = max(i + 1, j)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_collapsed(words, found):
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return [w for k, w in enumerate(words) if k not in gone]


def periodic(rng, n, letters):
    words = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randrange(3)):
        a = rng.randrange(n)
        p = rng.randrange(1, 9)
        end = min(n, a + p * rng.randrange(1, 12))
        for k in range(a + p, end):
            words[k] = words[k - p]
    return words


words_of = st.integers(1, 4).flatmap(lambda k: st.lists(st.integers(0, k), max_size=60))


@settings(max_examples=500, deadline=None)
@given(words_of, st.sampled_from([2, 3, 5, 12]))
def test_runs_match_all_periods(words, least):
    assert list(map(tuple, runs.runs_of(np.array(words, np.int64), least).tolist())) == brute_runs(words, least)
    assert list(map(tuple, runs.find_runs([str(w).encode() for w in words], least).tolist())) == brute_runs(words, least)


def test_longer_texts():
    rng = random.Random(3)
    for _ in range(150):
        words = [str(w).encode() for w in periodic(rng, rng.randrange(20, 400), rng.choice([2, 5, 300]))]
        found = runs.find_runs(words)
        assert list(map(tuple, found.tolist())) == brute_runs(words, 12)
        assert runs.collapsed(words, found) == brute_collapsed(words, found.tolist())


@settings(max_examples=200, deadline=None)
@given(words_of.filter(len))
def test_common_extensions_and_order(words):
    tree = runs.SuffixTree([w + 1 for w in words])
    n = len(words)
    pairs = [(i, j) for i in range(n) for j in range(n + 1) if i != j]
    got = tree.common(*(np.array(x) for x in zip(*pairs, strict=True))).tolist()

    def plain(i, j):
        k = 0
        while max(i, j) + k < n and words[i + k] == words[j + k]:
            k += 1
        return k

    assert got == [plain(i, j) for i, j in pairs]
    closed, opened = tree.ranks()
    suffixes = [words[i:] for i in range(n + 1)]
    assert np.argsort(closed).tolist() == sorted(range(n + 1), key=lambda i: suffixes[i])
    assert np.argsort(opened).tolist() == sorted(range(n + 1), key=lambda i: [*suffixes[i], 99])


@settings(max_examples=300, deadline=None)
@given(words_of, st.sampled_from([2, 7, 12]))
def test_stretches_hold_every_run(words, least):
    parts = runs.stretches(np.array(words, np.int64), least)
    assert all(a[1] < b[0] for a, b in zip(parts, parts[1:], strict=False))
    for s, n, _ in brute_runs(words, least):
        assert any(a <= s and s + n <= b for a, b in parts)


@pytest.mark.parametrize("unit", [1, 2, 7, 5000])
def test_long_repetitions(unit):
    words = [str(k % unit).encode() for k in range(60_000)]
    assert runs.find_runs(words).tolist() == [[0, 60_000, unit]]
    assert len(runs.collapsed(words, runs.find_runs(words))) == unit


def test_documents(frame):
    texts = {1: "a b " * 10, 2: None, 3: "", None: "x " * 12, 4: " \t\n", 5: "one two three", 6: "é é " * 12, 7: "w " * 11, 8: "b " + "a b\n" * 30000 + "c"}
    rows = [(i, t, "clash", 5) for i, t in texts.items()] + [(1, texts[1], "clash", 5)]
    got = runs.periodic_runs(frame(rows, "doc_id long, text string, runs string, n_words int")).collect()
    assert len(got) == len(rows)
    for r in got:
        words = [w.encode() for w in (texts[r["doc_id"]] or "").replace(" ", "NBSP").split()]
        expect = brute_runs(words, 12) if len(words) < 1000 else [(0, 60001, 2)]
        assert r["n_words"] == len(words)
        assert [(x["start"], x["length"], x["period"]) for x in r["runs"]] == expect
        assert r["collapsed"].replace(" ", "NBSP").split(" ") == [w.decode() for w in brute_collapsed(words, expect)] or (not words and r["collapsed"] == "")
    assert runs.periodic_runs(frame([], "doc_id long, text string")).collect() == []
