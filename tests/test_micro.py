"""The hand-checkable micro fixture (N = 2, threshold 4.0)."""

import pytest
from pyspark.sql import functions as F

from segrec.operators import (
    cluster_item_scores,
    evaluate,
    explode_genres,
    pack_documents,
    recommend,
    user_features,
    with_clusters,
)

TRAIN = [(1, 10, 5.0, 1), (1, 11, 3.0, 2), (2, 10, 4.0, 3), (2, 12, 4.0, 4), (3, 11, 2.0, 5),
         (3, 13, 5.0, 6), (3, 13, 3.0, 7), (4, 99, 4.0, 8)]
TEST = [(1, 12, 4.0, 9), (2, 11, 5.0, 10), (2, 13, 4.0, 11), (3, 99, 4.0, 12), (4, 11, 3.0, 13)]
CLUSTERS = [(1, 0), (2, 0), (3, 1), (4, 1)]
ITEMS = [(10, "A", "Drama|Sci-Fi"), (11, "B", "Comedy"), (12, "C", "Drama"), (13, "D", None)]
RATING_SCHEMA = "userId bigint, movieId bigint, rating double, timestamp bigint"


@pytest.fixture(scope="module")
def micro(spark):
    train = spark.createDataFrame(TRAIN, RATING_SCHEMA)
    test = spark.createDataFrame(TEST, RATING_SCHEMA)
    feats = user_features(train)
    clusters = feats.join(spark.createDataFrame(CLUSTERS, "userId bigint, cluster bigint"), "userId")
    items = spark.createDataFrame(ITEMS, "movieId bigint, title string, genres string")
    rated = with_clusters(train, clusters)
    scores = cluster_item_scores(rated)
    recs = recommend(rated, clusters, scores, items, top_n=2)
    return dict(train=train, test=test, feats=feats, clusters=clusters, items=items, rated=rated,
                scores=scores, recs=recs)


def test_user_features(micro):
    got = {r.userId: (r.movies_rated, round(r.avg_rating, 6)) for r in micro["feats"].collect()}
    assert got == {1: (2, 4.0), 2: (2, 4.0), 3: (3, 3.333333), 4: (1, 4.0)}


def test_cluster_scores(micro):
    got = {(r.cluster, r.movieId): (r.cluster_avg_movie_rating, r.cluster_rating_count,
                                    round(r.recommendation_score, 6)) for r in micro["scores"].collect()}
    assert got == {
        (0, 10): (4.5, 2, 4.943755), (0, 12): (4.0, 1, 2.772589), (0, 11): (3.0, 1, 2.079442),
        (1, 13): (4.0, 2, 4.394449), (1, 99): (4.0, 1, 2.772589), (1, 11): (2.0, 1, 1.386294),
    }


def test_top2(micro):
    rows = micro["recs"].orderBy("userId", "rank").collect()
    got = {}
    for r in rows:
        got.setdefault(r.userId, []).append((r.movieId, r.title, r.rank))
    assert got == {1: [(12, "C", 1)], 2: [(11, "B", 1)], 3: [(99, None, 1)],
                   4: [(13, "D", 1), (11, "B", 2)]}


def test_metrics(micro):
    global_m, per_user = evaluate(micro["recs"], micro["test"], top_n=2, threshold=4.0)
    got = {r.userId: (r.relevant_count, r.hits, r.precision_at_k, r.recall_at_k) for r in per_user.collect()}
    assert got == {1: (1, 1, 0.5, 1.0), 2: (2, 1, 0.5, 0.5), 3: (1, 1, 0.5, 1.0)}
    g = global_m.collect()[0]
    assert g.precision_at_k == 0.5 and round(g.recall_at_k, 6) == 0.833333 and g.evaluated_users == 3


def test_genres(micro):
    vocab = ["Drama", "Comedy", "SciFi"]
    off = sorted(tuple(r) for r in explode_genres(micro["items"], vocab).collect())
    assert off == [(10, "Drama"), (11, "Comedy"), (12, "Drama")]
    on = sorted(tuple(r) for r in explode_genres(micro["items"], vocab, normalize=True).collect())
    assert on == [(10, "Drama"), (10, "SciFi"), (11, "Comedy"), (12, "Drama")]


def test_large_vocabulary_uses_semi_join(micro):
    vocab = ["Drama", "Comedy"] + [f"g{i}" for i in range(1500)]
    got = sorted(tuple(r) for r in explode_genres(micro["items"], vocab).collect())
    assert got == [(10, "Drama"), (11, "Comedy"), (12, "Drama")]


def test_pack_orders_by_rank(micro):
    docs = pack_documents(micro["recs"]).filter(F.col("user_id") == 4).collect()
    assert [r.movie_id for r in docs[0].recommendations] == [13, 11]
