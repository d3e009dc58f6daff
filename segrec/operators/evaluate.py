"""Offline evaluation: Precision@N and Recall@N against the test split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def relevant_items(test: DataFrame, threshold: float = 4.0) -> DataFrame:
    """Distinct (userId, movieId) the user rated >= threshold in test (filter pushed to the scan)."""
    return test.filter(F.col("rating") >= F.lit(threshold)).select("userId", "movieId").distinct()


def relevant_counts(relevant: DataFrame) -> DataFrame:
    return relevant.groupBy("userId").agg(F.count("movieId").alias("relevant_count"))


def per_user_metrics(recs: DataFrame, relevant: DataFrame, top_n: int) -> DataFrame:
    """(userId, relevant_count, hits, precision_at_k, recall_at_k) for every user with at least
    one relevant item; users without recommendations get 0 hits. Precision divides by
    ``top_n`` even when fewer items were recommended.

    One left join (relevant pairs -> recommended pairs, both distinct) and one aggregate give
    both counts, instead of two aggregates and a second join."""
    rec_pairs = recs.select("userId", "movieId", F.lit(True).alias("_hit"))
    joined = relevant.join(rec_pairs, ["userId", "movieId"], "left")
    per_user = joined.groupBy("userId").agg(
        F.count(F.lit(1)).alias("relevant_count"),
        F.count("_hit").alias("hits"),
    )
    return (per_user
            .withColumn("precision_at_k", F.col("hits") / F.lit(top_n))
            .withColumn("recall_at_k", F.col("hits") / F.col("relevant_count")))


def global_metrics(per_user: DataFrame) -> DataFrame:
    """One row: mean precision, mean recall, evaluated users (NULL means when none)."""
    return per_user.agg(
        F.avg("precision_at_k").alias("precision_at_k"),
        F.avg("recall_at_k").alias("recall_at_k"),
        F.count("userId").alias("evaluated_users"),
    )


def evaluate(recs: DataFrame, test: DataFrame | None, top_n: int, threshold: float = 4.0,
             relevant: DataFrame | None = None):
    """(global_metrics, per_user_metrics). ``relevant`` may pass a precomputed (persisted)
    ``relevant_items(test, threshold)`` shared by several runs."""
    if relevant is None:
        relevant = relevant_items(test, threshold)
    per_user = per_user_metrics(recs, relevant, top_n)
    return global_metrics(per_user), per_user
