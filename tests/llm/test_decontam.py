import random
from collections import Counter
from itertools import combinations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from segrec.llm import decontam
from segrec.llm.queries import op5_decontamination

SCHEMA = "doc_id long, text string, item_id string, words int"
ITEM = "item_id long, text string, seeds string"


def case():
    rng = random.Random(6)
    word = lambda: rng.choice("bcdfgh") + rng.choice("aeiou") + str(rng.randrange(500))
    items = [(i, " ".join(word() for _ in range(rng.choice([15, 20, 57])))) for i in range(20)]
    items += [(90, None), (91, ""), (92, "a b"), (93, "short item of six words"), (94, items[0][1])]
    docs, leaks = [], set()
    for i in range(80):
        w = [word() for _ in range(rng.randrange(0, 200))]
        if i % 2:
            item, text = rng.choice(items[:20])
            t = text.split()
            for k in range(rng.randrange(0, 5), len(t), 6):  # every sixth word substituted
                t[k] = word()
            at = rng.randrange(len(w) + 1)
            w[at:at] = t
            leaks.add((i, item))
        docs.append((i, (", " if i % 3 else "\n").join(w)))
    docs += [(200, None), (201, ""), (202, items[3][1].upper().replace(" ", "! ")), (203, "a short item of six words."), (204, "a b a b")]
    leaks |= {(202, 3), (203, 93)}
    leaks |= {(d, 94) for d, i in leaks if i == 0}
    return docs, items, leaks


def test_substituted_passages_are_found_and_others_left(frame):
    docs, items, leaks = case()
    got = decontam.find_overlaps(frame([(*d, "clash", 1) for d in docs], SCHEMA), frame([(*i, "clash") for i in items], ITEM)).collect()
    assert {(r["row"]["doc_id"], r["item_id"]) for r in got} == leaks
    words, item_words = ({i: decontam.normal_words(t) for i, t in x} for x in (docs, items))
    for r in got:  # every overlap is what it says
        a = words[r["row"]["doc_id"]][r["doc_word"]:r["doc_word"] + r["n_words"]]
        b = item_words[r["item_id"]][r["item_word"]:r["item_word"] + r["n_words"]]
        equal = sum(x == y for x, y in zip(a, b, strict=True))
        assert equal == r["n_equal"] >= 0.8 * r["n_words"] and r["n_words"] >= min(13, len(item_words[r["item_id"]]))


def test_empty_tables_and_repeated_rows(frame):
    item = " ".join(f"w{i}" for i in range(15))
    assert decontam.find_overlaps(frame([], SCHEMA), frame([(1, item, "")], ITEM)).count() == 0
    assert decontam.find_overlaps(frame([(1, item, "", 0)], SCHEMA), frame([], ITEM)).count() == 0
    got = decontam.find_overlaps(frame([(1, item, "", 0), (1, item, "", 0), (None, item, "", 0)], SCHEMA), frame([(None, item, "")], ITEM))
    assert sorted(str(r["row"]["doc_id"]) for r in got.collect()) == ["1", "1", "None"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.booleans(), max_size=40))
def test_longest_span(equal):
    low, high = decontam.longest_span(np.array(equal, dtype=bool), 0.8)
    best = max((j - i for i in range(len(equal) + 1) for j in range(i, len(equal) + 1) if sum(equal[i:j]) >= 0.8 * (j - i) - 1e-9), default=0)
    assert sum(equal[low:high]) >= 0.8 * (high - low) - 1e-9
    assert best - 0.2 * best - 1 <= high - low <= best


@settings(max_examples=300, deadline=None)
@given(st.lists(st.booleans(), max_size=40), st.integers(1, 15))
def test_a_span_passes_if_any_window_does(equal, least):
    low, high = decontam.longest_span(np.array(equal, dtype=bool), 0.8)
    windows = [(i, j) for i in range(len(equal)) for j in range(i + least, len(equal) + 1) if 10 * sum(equal[i:j]) >= 8 * (j - i)]
    assert (high - low >= least) == bool(windows)
    if windows:
        a, b = decontam.trimmed(np.array(equal, dtype=bool), low, high, least)
        assert low <= a and b <= high and (a, b) in windows and sum(equal[a:b]) == sum(equal[low:high])


def test_substituted_ends_are_found(frame):
    cases = [(13, {0}), (13, {12}), (15, {0, 1, 14}), (15, {12, 13, 14}), (12, {0, 11}), (10, {0, 9}), (6, {0}), (6, {5}), (7, {0}), (8, {7})]
    items = [(k, " ".join(f"item{k}x{i}" for i in range(n)), "") for k, (n, _) in enumerate(cases)]
    docs = [(k, "some words " + " ".join(f"other{i}" if i in gone else f"item{k}x{i}" for i in range(n)) + " and more", "", 0)
            for k, (n, gone) in enumerate(cases)]
    got = decontam.find_overlaps(frame(docs, SCHEMA), frame(items, ITEM)).collect()
    assert sorted((r["row"]["doc_id"], r["item_id"]) for r in got) == [(k, k) for k in range(len(cases))]


def test_recall_by_item_length(frame):
    """Copies of items of 1 to 20 words with every pattern of substitutions that the rule allows (of long ones many)."""
    rng = random.Random(12)
    items, docs, wrong = [], [], []
    for n in range(1, 21):
        item = [f"i{n}w{k}" for k in range(n)]
        items.append((n, " ".join(item), ""))
        most = n - next(e for e in range(n + 1) if e >= 0.8 * n - 1e-9)
        patterns = set()
        if most <= 2:
            patterns = {frozenset(c) for m in range(most + 1) for c in combinations(range(n), m)}
        while len(patterns) < 60 and most > 2:
            patterns.add(frozenset(rng.sample(range(n), rng.randrange(most + 1))))
        for gone in patterns:
            docs.append((n * 1000 + len(docs), "so " + " ".join("other" if k in gone else w for k, w in enumerate(item)) + " end", "", 0))
        wrong.append((n, "so " + " ".join("other" if k < most + 1 else w for k, w in enumerate(item)) + " end"))
    got = {(r["row"]["doc_id"], r["item_id"]) for r in decontam.find_overlaps(frame(docs, SCHEMA), frame(items, ITEM), least_words=1).collect()}
    by_length = Counter(d[0] // 1000 for d in docs)
    for n in range(1, 21):
        ours = {i for i, item in got if item == n}
        assert {i // 1000 for i in ours} <= {n}
        assert len(ours) >= (1.0 if n <= 6 else 0.9) * by_length[n], (n, len(ours), by_length[n])
    # one word more substituted than the rule allows: no overlap of the whole item (spans of 13 words count)
    short = [(n, t, "", 0) for n, t in wrong if n <= 13]
    assert decontam.find_overlaps(frame(short, SCHEMA), frame(items, ITEM), least_words=1).count() == 0
    # items below the least number of words are left out
    got = decontam.find_overlaps(frame(docs, SCHEMA), frame(items, ITEM)).collect()
    assert {r["item_id"] for r in got} == set(range(5, 21))


def test_query_finds_verbatim_passages(spark):
    sf = "/root/testdata/sf0.01"
    flat = lambda t: " ".join(t.split())
    items = [flat(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs = {r["doc_id"]: flat(r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    leaked = {i for i, t in docs.items() if any(x in t for x in items)}
    got = {r["doc_id"] for r in op5_decontamination(spark, sf).collect()}
    assert leaked and leaked <= got and len(got - leaked) <= 0.05 * len(leaked)


def test_query_matches_all_alignments(spark):
    sf = "/root/testdata/sf0.001"
    items = [(r["item_id"], decontam.normal_words(r["text"])) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs = [(r["doc_id"], decontam.normal_words(r["text"])) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = set()
    for item, ours in items:
        places = {}
        for i, w in enumerate(ours):
            places.setdefault(w, []).append(i)
        for doc, theirs in docs:
            shifts = Counter(j - i for j, w in enumerate(theirs) for i in places.get(w, ()))
            for shift, n in shifts.items():
                if n >= 0.8 * min(13, len(ours)):  # else no span can agree
                    low, high = max(0, -shift), min(len(ours), len(theirs) - shift)
                    a, b = decontam.longest_span(np.array([x == y for x, y in zip(ours[low:high], theirs[low + shift:high + shift], strict=True)]), 0.8)
                    if b - a >= min(13, len(ours)):
                        want.add((doc, item))
    got = {(r["doc_id"], r["item_id"]) for r in op5_decontamination(spark, sf).collect()}
    assert want and got == want
