"""Edge rules: empty evaluation, NULL metrics ordering, short lists, duplicate items, NULL
ratings, first-K-wins ties."""

from pyspark.sql import functions as F

from segrec.operators import (
    best_k,
    cluster_item_scores,
    evaluate,
    metrics_summary,
    recommend,
    union_metrics,
    user_features,
    with_clusters,
)
from segrec.operators import clusterable
from segrec.operators.scoring import user_features_from_pairs, user_item_pairs
from segrec.sources import dedupe_items, quarantine_ratings, usable_ratings, valid_ratings

SCHEMA = "userId bigint, movieId bigint, rating double, timestamp bigint"


def test_nothing_relevant_gives_null_means(spark):
    train = spark.createDataFrame([(1, 10, 5.0, 1), (2, 11, 3.0, 2)], SCHEMA)
    test = spark.createDataFrame([(1, 11, 2.0, 3)], SCHEMA)
    clusters = spark.createDataFrame([(1, 0), (2, 0)], "userId bigint, cluster bigint")
    rated = with_clusters(train, clusters)
    recs = recommend(rated, clusters, cluster_item_scores(rated), None, top_n=5)
    g, per_user = evaluate(recs, test, top_n=5, threshold=4.0)
    row = g.collect()[0]
    assert per_user.count() == 0
    assert row.precision_at_k is None and row.recall_at_k is None and row.evaluated_users == 0


def test_short_list_precision_divides_by_n(spark):
    train = spark.createDataFrame([(1, 10, 5.0, 1), (2, 11, 4.0, 2)], SCHEMA)
    test = spark.createDataFrame([(1, 11, 5.0, 3)], SCHEMA)
    clusters = spark.createDataFrame([(1, 0), (2, 0)], "userId bigint, cluster bigint")
    rated = with_clusters(train, clusters)
    recs = recommend(rated, clusters, cluster_item_scores(rated), None, top_n=10)
    assert recs.filter(F.col("userId") == 1).count() == 1  # only one unseen item in the cluster
    _, per_user = evaluate(recs, test, top_n=10)
    r = per_user.collect()[0]
    assert (r.hits, r.precision_at_k, r.recall_at_k) == (1, 0.1, 1.0)


def test_duplicate_catalogue_lines_do_not_duplicate_recommendations(spark):
    train = spark.createDataFrame([(1, 10, 5.0, 1), (2, 11, 4.0, 2)], SCHEMA)
    clusters = spark.createDataFrame([(1, 0), (2, 0)], "userId bigint, cluster bigint")
    items = spark.createDataFrame([(11, "B", "x"), (11, "A", "y"), (10, "C", None)],
                                  "movieId bigint, title string, genres string")
    rated = with_clusters(train, clusters)
    recs = recommend(rated, clusters, cluster_item_scores(rated), dedupe_items(items), 5)
    rows = sorted((r.userId, r.movieId, r.title) for r in recs.collect())
    assert rows == [(1, 11, "A"), (2, 10, "C")]


def test_null_rating_rows_are_dropped_before_features(spark):
    raw = spark.createDataFrame([(1, 10, None, 1), (1, 11, 4.0, 2), (None, 12, 3.0, 3)], SCHEMA)
    feats = user_features(valid_ratings(raw)).collect()
    assert [(r.userId, r.movies_rated, r.avg_rating) for r in feats] == [(1, 1, 4.0)]


def test_null_ratings_count_as_seen_and_not_in_features(spark):
    raw = spark.createDataFrame([(1, 10, None, 1), (1, 11, 4.0, 2), (2, 10, 5.0, 3), (2, 12, 3.0, 4), (3, 12, None, 5),
                                 (None, 12, 3.0, 6), (4, None, 3.0, 7)], SCHEMA)
    usable = usable_ratings(raw)
    pairs = user_item_pairs(usable)
    feats = clusterable(user_features_from_pairs(pairs))
    assert sorted((r.userId, r.movies_rated, r.avg_rating) for r in feats.collect()) == [(1, 1, 4.0), (2, 2, 4.0)]
    clusters = feats.select("userId", F.lit(0).alias("cluster"))
    rated = with_clusters(pairs, clusters)
    recs = recommend(rated, clusters, cluster_item_scores(rated), None, 5).collect()
    assert sorted((r.userId, r.movieId) for r in recs) == [(1, 12), (2, 11)]  # item 10 is seen by user 1
    assert sorted((str(r.userId), str(r.movieId), r.reason) for r in quarantine_ratings(raw).collect()) == [
        ("4", "None", "no item"), ("None", "12", "no user")]


def test_dedupe_prefers_a_title(spark):
    items = spark.createDataFrame([(1, None, None), (1, "Real", None), (1, "Real", "Drama"), (2, None, "x"), (3, None, None)],
                                  "movieId bigint, title string, genres string")
    assert sorted((r.movieId, r.title, r.genres) for r in dedupe_items(items).collect()) == [
        (1, "Real", "Drama"), (2, None, "x"), (3, None, None)]


def test_best_k_first_wins_and_nulls_last(spark):
    rows = [(None, None, 0, 3), (0.2, 0.5, 10, 5), (0.2, 0.9, 10, 8)]
    metrics = [spark.createDataFrame([r], "precision_at_k double, recall_at_k double, "
                                          "evaluated_users bigint, k bigint") for r in rows]
    allm = union_metrics(metrics)
    assert best_k(allm).collect()[0].k == 5
    assert [r.k for r in metrics_summary(allm).collect()] == [8, 5, 3]
