"""Cluster-level aggregates: item scores, genre counts, top genres, cluster stats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segrec.config import train_buckets
from segrec.functions.expressions import recommendation_score, split_bucket
from segrec.operators.ranking import top_n_per_group


def score_order() -> list:
    """The within-cluster item order: score desc, rating count desc, movieId asc (total)."""
    return [F.col("recommendation_score").desc(), F.col("cluster_rating_count").desc(),
            F.col("movieId").asc()]


def user_item_pairs(train: DataFrame) -> DataFrame:
    """One row per distinct (userId, movieId): rating_sum, rating_n (non-NULL ratings) and rows.

    The single aggregation of the rating table everything else starts from (user features,
    item scores, genre counts, seen items). Partial aggregation runs map-side and the shuffle
    is on (userId, movieId), so one user holding a large share of all rows is spread over many
    partitions by item instead of landing in one task."""
    return train.groupBy("userId", "movieId").agg(
        F.sum("rating").alias("rating_sum"),
        F.count("rating").alias("rating_n"),
        F.count("movieId").alias("rows"),
    )


def split_pairs(ratings: DataFrame, train_fraction: float = 0.8, threshold: float = 4.0,
                buckets: int = 10) -> DataFrame:
    """One pass over the rating table for both sides of the hash split: per distinct
    (userId, movieId) the train aggregates of ``user_item_pairs`` (rating_sum, rating_n, rows),
    ``in_train`` (the pair has a train row) and ``relevant`` (a test row rated >= threshold).

    ``pairs_of(split)`` equals ``user_item_pairs(train)`` and ``relevant_of(split)`` equals
    ``relevant_items(test, threshold)`` of ``hash_split``: one scan and one shuffle instead of
    one per side."""
    cut = train_buckets(train_fraction, buckets)
    bucket = split_bucket("userId", "movieId", "timestamp", buckets=buckets)
    in_train, in_test = bucket < cut, bucket >= cut
    rating = F.col("rating")
    return ratings.groupBy("userId", "movieId").agg(
        F.sum(F.when(in_train, rating)).alias("rating_sum"),
        F.count(F.when(in_train, rating)).alias("rating_n"),
        F.count(F.when(in_train, F.col("movieId"))).alias("rows"),
        (F.count(F.when(in_train, F.lit(1))) > 0).alias("in_train"),
        F.coalesce(F.max(F.when(in_test & (rating >= F.lit(threshold)), F.lit(True))),
                   F.lit(False)).alias("relevant"),
    )


def pairs_of(split: DataFrame) -> DataFrame:
    """The train user-item pairs of a ``split_pairs`` table."""
    return split.filter(F.col("in_train")).select("userId", "movieId", "rating_sum", "rating_n", "rows")


def relevant_of(split: DataFrame) -> DataFrame:
    """The relevant test pairs of a ``split_pairs`` table."""
    return split.filter(F.col("relevant")).select("userId", "movieId")


def user_features_from_pairs(pairs: DataFrame) -> DataFrame:
    """(userId, movies_rated, avg_rating) from ``user_item_pairs``; equal to ``user_features``
    on the rows that have a rating (counted with duplicates)."""
    return pairs.groupBy("userId").agg(
        F.sum("rating_n").alias("movies_rated"),
        F.try_divide(F.sum("rating_sum"), F.sum("rating_n")).alias("avg_rating"),
    )


def with_clusters(pairs: DataFrame, user_clusters: DataFrame, cluster_cols: tuple[str, ...] = ("cluster",)) -> DataFrame:
    """(userId, movieId, <cluster_cols>, rating_sum, rating_n, rows): the user-item pairs tagged
    with the user's cluster, or with the clusters of every run of a sweep in one join. Raw
    rating rows are aggregated to pairs first.

    Computed once and shared by item scores, genre counts and the seen-item ranks. The join
    is on userId and the cluster side has one row per user. Pass a table that was written
    (``session.stored``): then both sides are shuffled for this join only and AQE splits a
    partition that a hot user makes huge, or broadcasts the users if their bytes allow it."""
    if "rating_sum" not in pairs.columns:
        pairs = user_item_pairs(pairs)
    return pairs.join(user_clusters.select("userId", *cluster_cols), "userId")


def clusters_of(tagged: DataFrame, cluster_col: str) -> DataFrame:
    """One run's ``with_clusters`` table out of a sweep's."""
    return tagged.select("userId", "movieId", F.col(cluster_col).alias("cluster"), "rating_sum", "rating_n", "rows")


def cluster_item_scores(rated: DataFrame) -> DataFrame:
    """(cluster, movieId, cluster_avg_movie_rating, cluster_rating_count, recommendation_score)
    from ``with_clusters`` output; the mean is the ratio of summed sums and counts (NULL when
    no rating is present). Map-side partial aggregation per (cluster, movieId)."""
    agg = rated.groupBy("cluster", "movieId").agg(
        F.try_divide(F.sum("rating_sum"), F.sum("rating_n")).alias("cluster_avg_movie_rating"),
        F.sum("rating_n").alias("cluster_rating_count"),
    )
    return agg.withColumn("recommendation_score",
                          recommendation_score("cluster_avg_movie_rating", "cluster_rating_count"))


def cluster_genres(rated: DataFrame, item_genres: DataFrame) -> DataFrame:
    """(cluster, genre, count): rated rows per cluster and genre of the rated item.

    Rows are first summed per (cluster, item); only those counts meet the genre bridge, so the
    per-genre fan-out applies to distinct (cluster, item) pairs and not to every rating."""
    per_item = rated.groupBy("cluster", "movieId").agg(F.sum("rows").alias("_n"))
    return (per_item.join(item_genres, "movieId")
            .groupBy("cluster", "genre")
            .agg(F.sum("_n").alias("count")))


def top_genres(genres: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most counted genres of every cluster (count desc, genre asc), one plan for
    all clusters."""
    return top_n_per_group(genres, ["cluster"], [F.col("count").desc(), F.col("genre").asc()], n)


def cluster_stats(user_clusters: DataFrame) -> DataFrame:
    """(cluster, avg_movies_rated, avg_user_rating, num_users)."""
    return user_clusters.groupBy("cluster").agg(
        F.avg("movies_rated").alias("avg_movies_rated"),
        F.avg("avg_rating").alias("avg_user_rating"),
        F.count("userId").alias("num_users"),
    )
