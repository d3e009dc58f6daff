"""Preparation and profiling: genre bridge, rating histogram, dataset profile, splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segrec.config import train_buckets
from segrec.functions.expressions import split_bucket
from segrec.session import cut_lineage


def explode_genres(items: DataFrame, vocabulary: Sequence[str] | DataFrame, normalize: bool = False) -> DataFrame:
    """(movieId, genres 'A|B|C') -> one (movieId, genre) row per listed genre in ``vocabulary``.

    A list is a hash set within the filter. A DataFrame (its first column, of any length; repeats and
    nulls change nothing) is a left-semi join on the genre: which side is sent to all tasks, or that
    none is, is decided by the bytes at run time, and AQE splits a genre that very many items list.

    A NULL genres string yields no row. ``normalize`` strips everything but ASCII letters from
    each listed genre before the membership test (so 'Sci-Fi' matches 'SciFi').
    """
    genre = F.explode(F.split(F.col("genres"), r"\|")).alias("genre")
    out = items.select("movieId", genre)
    if normalize:
        out = out.withColumn("genre", F.regexp_replace("genre", "[^A-Za-z]", ""))
    if isinstance(vocabulary, DataFrame):
        known = vocabulary.select(F.col(f"`{vocabulary.columns[0]}`").cast("string").alias("genre"))
        # semi, so repeats need no distinct (a shuffle of their own); null matches nothing
        return out.join(known, "genre", "left_semi").select("movieId", "genre")
    return out.filter(F.col("genre").isNotNull() & F.col("genre").isin(list(dict.fromkeys(vocabulary))))


def rating_distribution(ratings: DataFrame) -> DataFrame:
    """Histogram of rating values, ordered by rating."""
    return ratings.groupBy("rating").agg(F.count(F.lit(1)).alias("count")).orderBy("rating")


def profile(ratings: DataFrame, items: DataFrame, approx: bool = False) -> DataFrame:
    """One row: rating rows, distinct users, distinct rated items, item rows.

    ``approx=True`` uses HyperLogLog sketches (no distinct shuffle, ~2% error).
    """
    distinct = F.approx_count_distinct if approx else F.count_distinct
    item_rows = items.select(F.count(F.lit(1))).scalar()
    return ratings.agg(
        F.count(F.lit(1)).alias("ratings_rows"),
        distinct("userId").alias("distinct_users"),
        distinct("movieId").alias("distinct_items"),
    ).withColumn("item_rows", item_rows)


def split_profile(train: DataFrame, test: DataFrame) -> DataFrame:
    """One row: train rows and test rows."""
    test_rows = test.select(F.count(F.lit(1))).scalar()
    return train.agg(F.count(F.lit(1)).alias("train_rows")).withColumn("test_rows", test_rows)


def random_split(ratings: DataFrame, weights: Sequence[float] = (0.8, 0.2),
                 seed: int = 42) -> list[DataFrame]:
    """Spark's seeded ``randomSplit`` (as the original job) of a checkpoint of the input, so
    that both sides are cut from the same rows in the same order and every row is in exactly
    one. The split depends on the input partitioning: the same seed can give different rows on
    another layout."""
    return cut_lineage(ratings).randomSplit(list(weights), seed=seed)


def hash_split(ratings: DataFrame, train_fraction: float = 0.8, buckets: int = 10,
               keys: tuple[str, str, str] = ("userId", "movieId", "timestamp")) -> tuple[DataFrame, DataFrame]:
    """Deterministic split on an integer hash of (user, item, timestamp): a row's side never
    depends on partitioning or task retries. ``train_fraction`` must be whole buckets."""
    cut = train_buckets(train_fraction, buckets)
    bucket = split_bucket(*keys, buckets=buckets)
    return ratings.filter(bucket < cut), ratings.filter(bucket >= cut)
