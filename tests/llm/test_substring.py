import random

import brute_llm as brute
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from segrec.llm import substring
from segrec.llm.queries import op2_substring_dedup

SCHEMA = "doc_id long, text string, chunk string, n_words int, row string"


def corpus():
    rng = random.Random(5)
    word = lambda: rng.choice(["a", "of", "the", "xy", "\u00e9t\u00e9", "qq", "zed", "foo", "bar"]) + str(rng.randrange(40))
    passage = [word() for _ in range(12)]
    docs = []
    for i in range(60):
        w = [word() for _ in range(rng.randrange(0, 60))]
        if i % 3 == 0:
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage
        docs.append((i, rng.choice([" ", "\n", "  \t"]).join(w)))
    docs += [(100, docs[4][1]), (101, None), (102, ""), (103, " \n "), (104, "x " * 50), (105, "one two")]
    docs += [(106, " ".join(word() for _ in range(30_000)))]
    return docs


def run(frame, docs, width, **options):
    df = frame([(*d, "c", 1, "r") for d in docs], SCHEMA)
    out = substring.remove_repeats(df, width=width, **options)
    words = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " ")
    out = out.select("row.doc_id", "row.row", "text", "n_words", "n_removed",
                     F.sha2(F.regexp_replace(words, "^ | $", ""), 256).alias("kept"))
    return out.collect()


def test_matches_brute_force(frame):
    docs = corpus()
    for options in ({}, {"chunk_bytes": 400}):  # many chunks: repeats meet across chunks only
        got = run(frame, docs, 8, **options)
        assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in got} == brute.repeats(docs, 8)
    texts = dict(docs)
    for r in got:
        assert r["row"] == "r"
        if not r["n_removed"]:
            assert r["text"] == texts[r["doc_id"]]


def test_repeated_rows_and_empty_table(frame):
    text = " ".join(f"w{i}" for i in range(10))
    got = run(frame, [(1, text), (1, text), (None, "short")], 10)
    assert sorted((str(r["doc_id"]), r["n_removed"]) for r in got) == [("1", 10), ("1", 10), ("None", 0)]
    assert run(frame, [], 10) == []


def test_small_sketches_lose_nothing(frame, monkeypatch):
    docs = corpus()[:40]
    monkeypatch.setattr(substring, "CELLS_PER_WINDOW", 0.0001)  # crowded cells only let more windows pass
    got = run(frame, docs, 8)
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in got} == brute.repeats(docs, 8)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 10**6), unique=True))
def test_cells_round_trip(cells):
    cells = np.array(sorted(cells), dtype=np.int64)
    assert substring.unpack_cells(substring.pack_cells(cells)).tolist() == cells.tolist()


def test_query(spark, importable):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = {r["doc_id"]: tuple(r)[1:] for r in op2_substring_dedup(spark, "/root/testdata/sf0.001").collect()}
    assert got == brute.repeats(docs, 35)
