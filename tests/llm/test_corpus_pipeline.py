import brute_llm as brute
import corpus_pipeline

SF = "/root/testdata/sf0.01"


def test_stages_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < 4:
            assert tuple(out.columns) == tuple(docs.columns)
        rows = {r["doc_id"]: r for r in out.collect()}
        kept.append(rows)
        docs = spark.createDataFrame(list(rows.values()), out.schema) if k < 4 else None
    quality, near, cut, clean, pieces = kept
    groups = brute.near([(i, r["text"]) for i, r in quality.items()], 5)
    assert set(near) == {i for i, (_, c) in groups.items() if i == c}
    expect = brute.repeats([(i, r["text"]) for i, r in near.items()], 50)
    assert set(cut) == {i for i, (n, gone, _) in expect.items() if gone < n or not n}
    for i, r in cut.items():
        assert len(r["text"].split()) == expect[i][0] - expect[i][1] and r["n_chars"] == len(r["text"])
    assert set(clean) <= set(cut) and set(pieces) == set(clean)
    assert all(r["round_trip"] and len(r["piece_ids"]) == r["n_pieces"] for r in pieces.values())


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def words(start, n):
    return " ".join(f"w{k}" for k in range(start, start + n))


def rows_of(out):
    return sorted((r["doc_id"], r["text"]) for r in out.collect() if r["doc_id"] is not None), sorted(r["text"] for r in out.collect() if r["doc_id"] is None)


def test_near_dedup_judges_rows(spark):
    a, b, c = words(0, 60), words(100, 60), words(200, 60)
    near_a = a + " more"
    rows = [(5, a), (3, near_a), (None, a), (None, near_a), (3, b), (4, b), (None, b), (None, c), (None, c), (7, None), (7, None), (None, ""), (3, "short")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], COLUMNS).repartition(4)
    out = corpus_pipeline.minhash_near_dedup(spark, docs, SF)
    assert tuple(out.columns) == corpus_pipeline.COLUMNS
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    # of each group the smallest id, else one of the rows without: texts without words are no copies
    assert got == sorted([(3, near_a), (3, b), (None, c), (7, None), (7, None), (None, ""), (3, "short")], key=str)


def test_decontamination_judges_rows(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    clean = words(0, 50)
    rows = [(1, clean), (1, f"so {item} then"), (None, item), (None, clean), (2, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], COLUMNS).repartition(3)
    got = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.benchmark_decontamination(spark, docs, SF).collect()), key=str)
    assert got == sorted([(1, clean), (None, clean), (2, None), (None, "")], key=str)


def test_stages_of_an_empty_table(spark):
    empty = spark.createDataFrame([], COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == []


def test_last_stage_gives_the_librarys_pieces(spark, model):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    out = corpus_pipeline.sentencepiece_encoding(spark, docs, SF).collect()
    assert len(out) == len(texts)
    for r in out:
        assert r["piece_ids"] == sp.encode(texts[r["doc_id"]]) and r["n_pieces"] == len(r["piece_ids"]) and r["round_trip"]
        assert sp.decode(r["best_ids"]) == sp.decode(r["piece_ids"])


def test_run_equals_the_stages(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and all(r["round_trip"] for r in rows)
    assert len({r["doc_id"] for r in rows}) == len(rows)
