"""Served-table operators: pack/flatten, lookup, missing, page, stats, preview."""

import pytest

from segrec.operators import (
    count_documents,
    document_stats,
    flatten_documents,
    lookup,
    missing,
    pack_documents,
    page,
    page_envelope,
    preview_documents,
)

RECS = [
    (1, 0, 10, "A very long title that goes beyond thirty chars", 3.0, 1),
    (1, 0, 11, "B", 2.0, 2),
    (1, 0, 12, "C", 1.5, 3),
    (1, 0, 13, None, 1.0, 4),
    (2, 1, 20, "Z", 5.0, 1),
]
SCHEMA = "userId bigint, cluster bigint, movieId bigint, title string, recommendation_score double, rank bigint"


@pytest.fixture(scope="module")
def docs(spark):
    return pack_documents(spark.createDataFrame(RECS, SCHEMA)).cache()


def test_flatten_inverts_pack(docs):
    flat = sorted(tuple(r) for r in flatten_documents(docs).collect())
    assert flat == sorted((u, c, rk, m, t, s) for u, c, m, t, s, rk in RECS)


def test_lookup_and_missing(spark, docs):
    assert [r.user_id for r in lookup(docs, [2, 3]).collect()] == [2]
    ids = spark.createDataFrame([(1,), (3,), (3,)], "id bigint")
    assert [r.user_id for r in lookup(docs, ids).collect()] == [1]
    assert [r.user_id for r in missing(docs, ids).collect()] == [3]


def test_page(docs):
    assert [r.user_id for r in page(docs, limit=1, offset=1).collect()] == [2]
    assert page(docs, limit=5, offset=10).count() == 0
    with pytest.raises(ValueError):
        page(docs, limit=-1)


def test_page_envelope(docs):
    r = page_envelope(docs, limit=1, offset=1).collect()[0]
    assert (r.total, r.limit, r.offset, [u.user_id for u in r.users]) == (2, 1, 1, [2])
    assert page_envelope(docs, limit=5, offset=9).collect()[0].users == []


def test_runs_are_packed_apart(spark):
    recs = spark.createDataFrame([(*r, k) for r in RECS for k in (3, 5)], SCHEMA + ", k bigint")
    got = pack_documents(recs).collect()
    assert sorted((r.user_id, r.k, len(r.recommendations)) for r in got) == [(1, 3, 4), (1, 5, 4), (2, 3, 1), (2, 5, 1)]


def test_point_read_of_stored_documents(spark, docs, tmp_path):
    from segrec.sinks import write_documents
    from segrec.sources import read_documents

    write_documents(docs, str(tmp_path / "d"), "parquet")
    found = lookup(read_documents(spark, str(tmp_path / "d"), fmt="parquet", unique=True), [2])
    assert [r.user_id for r in found.collect()] == [2]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,2)]" in plan or "In(user_id" in plan


def test_stats(docs):
    r = document_stats(docs).collect()[0]
    assert (r.users, r.total_recommendations, r.avg_per_user, r.min_cluster, r.max_cluster) == (2, 5, 2.5, 0, 1)
    assert count_documents(docs).collect()[0].total_users == 2


def test_preview(docs):
    got = {r.user_id: (r.n_recommendations, r.preview) for r in preview_documents(docs).collect()}
    assert got[1] == (4, "A very long title that goes be... | B | C | +1 más")
    assert got[2] == (1, "Z")


def test_deep_page_matches_top_k(spark):
    recs = spark.range(1, 301).selectExpr("id AS userId", "id % 4 AS cluster", "id * 10 AS movieId",
                                           "'t' AS title", "1.0D AS recommendation_score", "1L AS rank")
    docs = pack_documents(recs)
    shallow = [r.user_id for r in page(docs, limit=25, offset=140).collect()]
    deep = [r.user_id for r in page(docs, limit=25, offset=140, topk_rows=10).collect()]
    assert shallow == deep == list(range(141, 166))
    assert [r.position for r in page(docs, limit=25, offset=140, topk_rows=10).collect()] == shallow
    assert page(docs, limit=10, offset=295, topk_rows=10).count() == 5
