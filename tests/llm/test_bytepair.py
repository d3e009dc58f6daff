import hashlib
import json
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from segrec.llm import bytepair
from segrec.llm.queries import op13_bpe_rank_array

SCHEMA = "doc_id long, text string, n_tokens int, token_ids string"
CHARACTERS = [*"aeth 1#'", "é", "日", "  ", "\n", "\t", "\x1c", "\x85", " ", "\xa0", "٣", "'s", "'ll", "the", "\0", "🙂", "՘", "\U0003d000", "�",
              "\U0010fffd", "Ⅷ", "½", "<|endoftext|>", "<|endof", "Ġ", "x" * 30]


@pytest.fixture(scope="module")
def path():
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def ids_of(library, text):
    return np.array(library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(CHARACTERS), max_size=14).map("".join) | st.text(max_size=20))
def test_texts_match_the_library(path, library, text):
    pairs = bytepair.byte_pairs(path)
    ids = pairs.encode(text)
    assert ids == ids_of(library, text)
    assert pairs.decode(ids) == library.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False) == text


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(list(b"aabtheinor \xc3\xa9")), min_size=1, max_size=80).map(bytes))
def test_both_merge_orders_agree(path, word):
    pairs = bytepair.byte_pairs(path)
    ids, bounds = pairs._scan(word)
    assert (ids, bounds) == pairs._merge_by_rank(word)
    assert [pairs.texts[i] for i in ids] == [word[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


@pytest.mark.parametrize("letters", ["ab", "abcdefghijklmnopqrstuvwxyz", "a", "#-=", "日本é", " ", "\n "])
def test_long_runs(path, library, letters, monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choice(letters) for _ in range(40_000))
    monkeypatch.setattr(bytepair, "SLICE", 3000)
    assert bytepair.byte_pairs(path).encode(text) == ids_of(library, text)


def test_slices_change_nothing(path, library, monkeypatch):
    monkeypatch.setattr(bytepair, "SLICE", 5)
    rng = random.Random(9)
    for _ in range(500):
        text = "".join(rng.choice(CHARACTERS) for _ in range(40))
        assert bytepair.byte_pairs(path).encode(text) == ids_of(library, text)


def test_memo_bound_changes_nothing(path, library, monkeypatch):
    monkeypatch.setattr(bytepair, "MEMO_BYTES", 2000)
    pairs = bytepair.BytePairs(path)
    text = " ".join(f"word{k}" for k in range(300))
    assert pairs.encode(text) == ids_of(library, text) and pairs._memo_bytes < 4000


def test_documents(frame, path, library):
    texts = {1: "a b", 2: None, 3: "", None: "x", 4: "<|endoftext|> é" * 3, 5: "z" * 50_000}
    rows = [(i, t, 7, "clash") for i, t in texts.items()] + [(1, "a b", 7, "clash")]
    encoded = bytepair.encode_documents(frame(rows, SCHEMA), path)
    assert encoded.columns == ["doc_id", "n_tokens", "token_ids"]
    decoded = bytepair.decode_documents(encoded, path).collect()
    assert len(decoded) == len(rows)
    for r in decoded:
        text = texts[r["doc_id"]] or ""
        assert (bytes(r["token_ids"]), r["text"], r["n_tokens"]) == (ids_of(library, text), text, len(library.encode(text, add_special_tokens=False).ids))
    assert bytepair.decode_documents(bytepair.encode_documents(frame([], SCHEMA), path), path).collect() == []


def test_made_up_ids_decode(frame, path, library):
    rng = random.Random(2)
    ids = [[rng.randrange(50257) for _ in range(rng.randrange(8))] for _ in range(200)]
    rows = [(k, np.array(x, "<u4").tobytes()) for k, x in enumerate(ids)] + [(900, None), (901, np.array([10**6], "<u4").tobytes())]
    got = {r["doc_id"]: r["text"] for r in bytepair.decode_documents(frame(rows, "doc_id long, token_ids binary"), path).collect()}
    assert got == {**{k: library.decode(x, skip_special_tokens=False) for k, x in enumerate(ids)}, 900: "", 901: ""}


@pytest.mark.parametrize("change", [{"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"merges": "turned"}])
def test_other_vocabularies_are_refused(path, tmp_path, change):
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if "merges" in change:
        spec["model"]["merges"] = spec["model"]["merges"][::-1]
    else:
        spec |= change
    other = tmp_path / "other.json"
    other.write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        bytepair.BytePairs(str(other))


def test_query_equals_the_library(spark, library):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op13_bpe_rank_array(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
