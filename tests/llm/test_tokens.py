import functools
import random
import tracemalloc

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from segrec.llm import nbest, pieces, tokencount
from segrec.llm.pieces import BLANK
from segrec.llm.queries import op4_sentencepiece_nbest, op8_token_counts

ODD = ["", "  hello  world \n x", "a\u2581b \u2581", "</s>[INST] ok", "\ufb01 \u00bd \u00e9 e\u0301", "\u3000x", "   ", "\x00a", " a", "a ",
       "a" * 60, "     b     c\t\t", "www....!!!!", "\u65e5\u672c\u8a9e\u30c6\u30ad\u30b9\u30c8\U0001f600", "==== ---- //// ((((("]
SF = "/root/testdata/sf0.001"


def texts():
    rng = random.Random(3)
    return ODD + ["".join(rng.choice("ab e.,\n(/=-\u2581 th\u00e9x0123") for _ in range(rng.randint(1, 60))) for _ in range(300)]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers

    return sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))


def test_every_prefix_as_the_library_counts_it(model, library):
    counter = tokencount.counter(model)
    for text in texts():
        assert counter.prefix_counts(text).tolist() == [len(library.encode(text[:i])) for i in range(len(text) + 1)]


def test_table_answers_budget_questions(frame, model, library):
    rows = list(enumerate([*texts()[:60], None]))
    table = tokencount.prefix_table(frame(rows, "doc_id long, text string"), model)
    table = table.select("doc_id", "n_tokens", tokencount.longest_within("count_deltas", 7).alias("fit"),
                         tokencount.tokens_at("count_deltas", F.lit(5)).alias("five"))
    for r in table.collect():
        text = rows[r["doc_id"]][1] or ""
        counts = [len(library.encode(text[:i])) for i in range(len(text) + 1)]
        assert (r["n_tokens"], r["fit"], r["five"]) == (counts[-1], max(i for i, n in enumerate(counts) if n <= 7), counts[min(5, len(text))])


def test_longest_prefix_looks_at_one_unit(model, library, monkeypatch):
    counter = tokencount.PrefixCounter(model)
    for text in texts()[:80]:
        counts = [len(library.encode(text[:i])) for i in range(len(text) + 1)]
        for budget in (0, 1, 2, 7, 30):
            assert counter.longest_prefix(text, budget) == max(i for i, n in enumerate(counts) if n <= budget)
    looked = []
    states = counter.segment_states
    monkeypatch.setattr(counter, "segment_states", lambda segment: looked.append(segment) or states(segment))
    counter.longest_prefix("some words of a long text " * 2000, 4096)
    assert len(looked) == 1


def test_counts_query(spark, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in op8_token_counts(spark, SF).collect():
        n = len(library.encode(docs[r["doc_id"]]))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(docs[r["doc_id"]].encode()), n, n > 4096)


def test_counts_of_odd_rows(frame, model):
    schema = "doc_id long, text string, n_tokens string, n_bytes int"
    got = tokencount.count_tokens(frame([(None, None, "x", 1), (1, "", "x", 1), (1, "", "x", 1), (2, "ab " * 9000, "x", 1)], schema), model)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [
        (None, 0, 0, False, 0), (1, 0, 0, False, 0), (1, 0, 0, False, 0), (2, 27000, *_long(model))]))
    assert tokencount.count_tokens(frame([], schema), model).count() == 0


def _long(model):
    counts = tokencount.counter(model).prefix_counts("ab " * 9000)
    return int(counts[-1]), True, int(max(i for i, n in enumerate(counts) if n <= 4096))


def test_small_memo_changes_nothing(model, monkeypatch):
    monkeypatch.setattr(tokencount, "CACHE", 50)
    small, usual = tokencount.PrefixCounter(model), tokencount.counter(model)
    assert [small.total(t) for t in texts()] == [usual.total(t) for t in texts()]


def test_long_runs_without_blanks_take_memory_by_their_length(model, library):
    rng = random.Random(5)
    base64 = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(8000))
    han = ["".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(1500)) for _ in range(4)]
    runs = [base64, "e" * 3000, "ing" * 1000, "\n".join(han)]
    counter = tokencount.PrefixCounter(model)
    tracemalloc.start()
    for text in runs:
        assert counter.total(text) == len(library.encode(text))
        assert counter.prefix_counts(text)[-1] == counter.total(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6  # every prefix as a string of its own: more than 40 MB


def test_memo_is_bounded_in_bytes(model, monkeypatch):
    monkeypatch.setattr(tokencount, "CACHE_BYTES", 5000)
    small, usual = tokencount.PrefixCounter(model), tokencount.counter(model)
    for text in texts():
        assert small.prefix_counts(text).tolist() == usual.prefix_counts(text).tolist() and small.total(text) == usual.total(text)
        assert sum(tokencount.ENTRY + 4 * len(x) for x in small.unit_total) <= 5000 + tokencount.ENTRY + 4 * tokencount.SHORT


def all_scores(coder, text):
    """Scores of all segmentations of a short text, best first."""
    norm = BLANK + text.replace(" ", BLANK) if text else ""
    best = {len(norm): [0]}
    for i in range(len(norm) - 1, -1, -1):
        out = []
        for j in range(i + 1, min(len(norm), i + 16) + 1):
            piece = norm[i:j]
            if piece in coder.vocab.scores:
                score = coder.vocab.scores[piece]
            elif j == i + 1:
                score = coder.byte_score * len(piece.encode())
            else:
                continue
            out += [score + x for x in best[j]]
        best[i] = sorted(out, reverse=True)[:40]
    return best[0]


def test_n_best_are_the_best(model):
    coder = nbest.lattice(model)
    for text in [t[:40] for t in texts()]:
        found = coder.encode(text, 6)
        assert [s for s, _ in found] == all_scores(coder, text)[:6]
        assert len({tuple(ids) for _, ids in found}) == len(found)
        assert found[0] == coder.encode(text, 1)[0]
        for score, ids in found:
            assert coder.decode(ids) == text.replace(BLANK, " ")


def test_n_best_of_a_long_unit(model):
    coder = nbest.Lattice(model)
    rng = random.Random(9)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    for n in range(1, 7):
        for text in ("".join(rng.choice(letters) for _ in range(150)), "www....!!!!" * 6):
            assert [s for s, _ in coder.encode(text, n)] == all_scores(coder, text)[:n]
    for text in ("".join(rng.choice(letters) for _ in range(6000)), "ing" * 2000):
        tracemalloc.start()
        found = coder.encode(text, 4)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 20e6  # whole index or cut tuples for every change take several times as much
        assert [s for s, _ in found] == all_scores(coder, text)[:4]
        assert len({tuple(ids) for _, ids in found}) == 4 and all(coder.decode(ids) == text for _, ids in found)
        assert coder.best(coder.vocab.units(text), 4)[1] == [s for s, _ in found]


def test_a_star_yields_in_order(model):
    coder = nbest.lattice(model)
    scores = [s for s, _ in coder.segment_paths(BLANK + "internationale")]
    assert scores == sorted(scores, reverse=True) and len(scores) > 50


def test_encoding_query_and_odd_rows(spark, frame, model):
    got = op4_sentencepiece_nbest(spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count() and all(r["round_trip"] for r in got)
    schema = "doc_id long, text string, piece_ids string"
    got = nbest.encode_documents(frame([(None, None, "x"), (1, "", "x"), (1, "", "x"), (3, "a b", "x")], schema), model).collect()
    assert sorted((str(r["doc_id"]), r["n_pieces"], r["nbest_scores"][:1] == [0], r["decoded"]) for r in got) == [
        ("1", 0, True, ""), ("1", 0, True, ""), ("3", 2, False, "a b"), ("None", 0, True, "")]
    assert nbest.encode_documents(frame([], schema), model).count() == 0


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "the", "ing", " ", "  ", "▁", "é", "日", "\n", "\t", "🙂", "\0", "<s>", "</s>", "1", "qu", "ick"]), max_size=30).map("".join)
       | st.text(max_size=20))
def test_merging_matches_the_library(text):
    import public_tokenizers

    path = str(public_tokenizers.path("piece_bpe_32k.model"))
    coder = pieces.merge_encoder(path)
    assert np.frombuffer(coder.encode(coder.vocab.units(text)), "<i4").tolist() == _library(path).encode(text)


@pytest.mark.parametrize("letters", ["ab", "etaoinshr", "a", "1", "日本"])
def test_merging_of_long_runs(model, letters):
    rng = random.Random(7)
    text = "".join(rng.choice(letters) for _ in range(30_000))
    coder = pieces.merge_encoder(model)
    assert np.frombuffer(coder.encode(coder.vocab.units(text)), "<i4").tolist() == _library(model).encode(text)


@functools.lru_cache(maxsize=1)
def _library(path):
    return sentencepiece.SentencePieceProcessor(model_file=path)


def test_changes_beyond_a_byte_are_refused():
    assert tokencount._signed_bytes(np.array([-128, 127, 0])) == bytes([128, 127, 0]) and tokencount._signed_bytes(np.array([], np.int64)) == b""
    for change in (-129, 128):
        with pytest.raises(ValueError):
            tokencount._signed_bytes(np.array([0, change]))
