import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from segrec.llm import quality
from segrec.llm.queries import op3_quality_classifier

SCHEMA = "doc_id long, text string, lang string, score string, kept int"


def kneser_ney(texts, order):
    """A plain modified Kneser-Ney model over bytes: returns log p(byte | bytes before)."""
    counts = {n: Counter() for n in range(1, order + 1)}
    for t in texts:
        padded = bytes(order - 1) + t
        for i in range(len(t)):
            counts[order][padded[i:i + order]] += 1
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    cut = {n: quality.discounts(Counter(c.values())) for n, c in counts.items()}
    followers = {n: defaultdict(list) for n in counts}
    for n, c in counts.items():
        for g, k in c.items():
            followers[n][g[:-1]].append(k)

    def p(gram, n):
        if n == 0:
            return 1 / 257
        gram = gram[-n:]
        below = p(gram, n - 1)
        seen = followers[n].get(gram[:-1])
        if not seen:
            return below
        take = lambda k: cut[n][min(k, 3) - 1]
        k = counts[n].get(gram, 0)
        return (k - take(k) if k else 0) / sum(seen) + sum(map(take, seen)) / sum(seen) * below

    return lambda gram: math.log(p(gram, order))


def corpus():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice(["the", "an", "ber", "ét", "lo", "ing"]) for _ in range(rng.randrange(1, 4)))
    docs = [(i, " ".join(word() for _ in range(rng.randrange(5, 60))), rng.choice(["en", "fr"])) for i in range(150)]
    docs += [(200 + i, "".join(rng.choice("#$%&*|xyzQ7") for _ in range(200)), "en") for i in range(10)]
    docs += [(300, None, "en"), (301, "", None), (302, "the an ber", "xx"), (303, docs[0][1], "en"), (304, "the lo " * 5000, None)]
    labels = [(i, 1, 0) for i in range(100)] + [(100, 1, 1), (101, 0, 0), (102, 1, 0), (102, 0, 0), (103, None, None), (None, 1, 0), (9999, 1, 0)]
    return docs, labels


@pytest.mark.parametrize("options", [{"order": 3}, {"order": 5, "chunk_bytes": 500}])
def test_perplexity_matches_a_plain_model(frame, options):
    docs, labels = corpus()
    trusted = set(range(100))
    df = frame([(*d, "clash", 7) for d in docs], SCHEMA)
    got = quality.score_documents(df, frame(labels, "doc_id long, quality int, toxic int"), with_text=True, **options).collect()
    assert len(got) == len(docs)
    fold = lambda t: xxhash.xxh3_64_intdigest(t) & 1
    raw = {i: (t or "").encode() for i, t, _ in docs}
    order = options["order"]
    models = {f: kneser_ney([raw[i] for i in trusted if fold(raw[i]) == f], order) for f in (0, 1)}
    for r in got:
        t = raw[r["row"]["doc_id"]]
        assert (r["text"] or "").encode() == t and r["row"]["score"] == "clash"
        if not t:
            assert r["perplexity"] is None and r["kept"]
            continue
        padded = bytes(order - 1) + t
        mean = sum(models[1 - fold(t)](padded[i:i + order]) for i in range(len(t))) / len(t)
        assert r["perplexity"] == pytest.approx(math.exp(-mean), rel=1e-4)
    kept = {r["row"]["doc_id"]: r["kept"] for r in got}
    assert not any(kept[200 + i] for i in range(10))
    assert sum(kept[i] for i in range(150)) >= 148


def rude_corpus(repeats):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["the", "an", "ber", "lo", "ing"]) for _ in range(rng.randrange(1, 4)))
    good = [" ".join(word() for _ in range(rng.randrange(8, 40))) for _ in range(60)]
    rude = [f"{good[k]} you zoxq {good[k + 1]} zoxqy" for k in range(12)]
    texts = [t for t in good + rude for _ in range(repeats)]
    docs = [(i, t, "en") for i, t in enumerate(texts)]
    return docs, [(i, 1, 0) if "zoxq" not in t else (i, 0, 1) for i, t, _ in docs]


def percentile(values, q):
    return sorted(values)[max(math.ceil(q * len(values)), 1) - 1]


@pytest.mark.parametrize("repeats", [1, 3, 5])
def test_repeated_texts_leave_no_zero_probability(frame, repeats):
    """Scores, toxicity, limits and decisions against a plain model, texts once and repeated."""
    docs, labels = rude_corpus(repeats)
    got = quality.score_documents(frame([(*d, "", 0) for d in docs], SCHEMA), frame(labels, "doc_id long, quality int, toxic int")).collect()
    fold = lambda t: xxhash.xxh3_64_intdigest(t) & 1
    raw = {i: t.encode() for i, t, _ in docs}
    clean, toxic = ([raw[i] for i, _, x in labels if x == mark] for mark in (0, 1))
    model = {(f, kind): kneser_ney([t for t in of if fold(t) == f], 5) for f in (0, 1) for kind, of in (("c", clean), ("t", toxic))}
    scores, toxicity = {}, {}
    for i, t in raw.items():
        grams = [(bytes(4) + t)[k:k + 5] for k in range(len(t))]
        by = {kind: [model[1 - fold(t), kind](g) for g in grams] for kind in "ct"}
        steps = [max(-127, min(127, round(12 * (b - a)))) for a, b in zip(by["c"], by["t"], strict=True)]
        toxicity[i] = max(sum(steps[max(0, k - 16):k]) for k in range(1, len(t) + 1)) / 12
        each = -np.array(by["c"])
        scores[i] = each.mean() - 2 * each.std() / math.sqrt(len(t))
    good = [i for i, _, x in labels if not x]

    def limit(of, few=1.0):
        mid, high = percentile([of[i] for i in good], 0.5), percentile([of[i] for i in good], 0.995)
        return high + 0.25 * few * (high - mid)

    threshold, toxic_limit = limit(scores), limit(toxicity, max(1.0, 200 / len(good)))
    assert len(got) == len(docs)
    for r in got:
        i = r["row"]["doc_id"]
        assert r["score"] == pytest.approx(scores[i], rel=1e-4) and r["threshold"] == pytest.approx(threshold, rel=1e-4)
        # a ratio close to half a step may round either way
        assert r["toxicity"] == pytest.approx(toxicity[i], abs=2 / 12) and r["toxic_limit"] == pytest.approx(toxic_limit, abs=1)
        assert all(math.isfinite(r[c]) for c in ("perplexity", "score", "toxicity"))
        if abs(toxicity[i] - toxic_limit) > 1 and abs(scores[i] - threshold) > 1e-3:
            assert r["kept"] == (scores[i] <= threshold and toxicity[i] <= toxic_limit)


@pytest.mark.parametrize("counts", [{}, {1: 5}, {3: 40}, {1: 1, 2: 400, 3: 1}, {1: 10, 2: 1, 3: 90, 4: 1}, {1: 10, 2: 10, 3: 10, 4: 900}])
def test_every_discount_leaves_mass(counts):
    assert all(0 < d < k + 1 for k, d in enumerate(quality.discounts(counts)))


@pytest.mark.parametrize("repeats", [1, 4])
def test_closed_alphabet(frame, repeats):
    """Texts of one letter, where every follower of a context has been seen."""
    docs = [(i, "a" * (5 + i % 7), "en") for i in range(20 * repeats)] + [(900, "ab", "en"), (901, "zzz", "en")]
    labels = [(i, 1, 0) for i in range(10 * repeats)] + [(i, 0, 1) for i in range(10 * repeats, 20 * repeats)]
    got = quality.score_documents(frame([(*d, "", 0) for d in docs], SCHEMA), frame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(docs) and all(math.isfinite(r["perplexity"]) and (r["toxicity"] is None or math.isfinite(r["toxicity"])) for r in got)


def test_no_labels_keeps_everything(frame):
    docs, _ = corpus()
    got = quality.score_documents(frame([(*d, "", 0) for d in docs], SCHEMA), frame([], "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(docs) and all(r["kept"] and r["threshold"] is None for r in got)


def test_empty_table(frame):
    got = quality.score_documents(frame([], SCHEMA), frame([(1, 1, 0)], "doc_id long, quality int, toxic int"))
    assert got.count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: (r["quality"], r["toxic"]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r["doc_id"]: r["kept"] for r in op3_quality_classifier(spark, sf).collect()}
    good = [kept[i] for i, v in labels.items() if v == (1, 0)]
    bad = [kept[i] for i, v in labels.items() if v[0] == 0]
    assert sum(good) >= 0.99 * len(good)
    assert sum(bad) <= 0.2 * len(bad)


def test_toxic_documents_are_rejected_by_a_model_that_did_not_see_them(spark):
    sf = "/root/testdata/sf0.1"
    insults = re.compile(r"\b(idiot|trash|moron|pathetic|worthless|disgusting|stupid|clown|loser|scum)\b", re.I)
    said = {r["doc_id"]: len(insults.findall(r["text"] or "")) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    labels = {r["doc_id"]: (r["quality"], r["toxic"]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r["doc_id"]: r["kept"] for r in op3_quality_classifier(spark, sf).collect()}
    toxic = [kept[i] for i, v in labels.items() if v[1] == 1]
    assert sum(toxic) <= 0.3 * len(toxic)  # four in ten of these labels have no insult in the text
    rude = [kept[i] for i, n in said.items() if n >= 2]
    assert sum(rude) <= 0.01 * len(rude)
    unlabelled = [kept[i] for i, n in said.items() if n >= 1 and i not in labels]
    assert sum(unlabelled) <= 0.01 * len(unlabelled)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(-127, 127), max_size=40), min_size=1, max_size=6))
def test_strongest_window(texts):
    got = quality.strongest_window(np.array([x for t in texts for x in t], dtype=np.int8), np.array([len(t) for t in texts]), 16)
    assert got.tolist() == [max((sum(t[max(0, k - 16):k]) for k in range(1, len(t) + 1)), default=0) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**56)))
def test_numbers_round_trip(numbers):
    packed = quality.pack_numbers(np.array(numbers, dtype=np.int64))
    assert quality.unpack_numbers(packed).tolist() == numbers
