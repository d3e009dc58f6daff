"""The standard derived tables over the Parquet test tables, shared by the registered queries,
the benchmark and the tests.

Intermediates read more than once inside a plan (the one-pass split aggregate that holds the
train user-item pairs and the relevant test pairs, the clustered pairs, the ranked item table,
the recommendations) are persisted, so the rating table is scanned and shuffled once per
plan instead of once per consumer. The users table (one row per user) is written into the
shared scratch folder when it is first needed; nothing else is eager but the ranking's
checkpoint, and nothing is collected.

Clusters are *injected* by default (``cluster = #thresholds below movies_rated``) so results
are deterministic and checkable against SQL; ``kmeans(k)`` gives the Spark ML ones.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.storagelevel import StorageLevel

from segrec.config import RunConfig
from segrec.operators.clusters import assign_by_thresholds, assign_clusters, fit_clusters
from segrec.operators.evaluate import per_user_metrics
from segrec.operators.features import clusterable, scale_features
from segrec.operators.prepare import explode_genres, hash_split
from segrec.operators.recommend import longest_history, rank_items, recommend
from segrec.operators.scoring import (
    cluster_item_scores,
    clusters_of,
    pairs_of,
    relevant_of,
    split_pairs,
    user_features_from_pairs,
    with_clusters,
)
from segrec.operators.serving import pack_documents
from segrec.session import stored
from segrec.sources.tables import TABLE_GENRES, items_from_tables, ratings_from_tables

_LEVEL = StorageLevel.MEMORY_AND_DISK

# Injected assignment used by the checked queries: 3 clusters split at 25 and 40 ratings.
INJECTED_THRESHOLDS = (25, 40)
# Injected assignments compared by the sweep queries (2, 3 and 5 clusters).
SWEEP_THRESHOLDS = ((32,), (25, 40), (20, 28, 36, 44))


class TableWorkload:
    def __init__(self, spark: SparkSession, sf_dir: str, cfg: RunConfig | None = None,
                 thresholds=INJECTED_THRESHOLDS):
        self.spark = spark
        self.sf_dir = sf_dir
        self.cfg = cfg or RunConfig(genre_vocabulary=TABLE_GENRES)
        self.thresholds = tuple(thresholds)

    @property
    def k(self) -> int:
        return len(self.thresholds) + 1

    @cached_property
    def ratings(self) -> DataFrame:
        return ratings_from_tables(self.spark, self.sf_dir)

    @cached_property
    def items(self) -> DataFrame:
        return items_from_tables(self.spark, self.sf_dir)

    @cached_property
    def item_genres(self) -> DataFrame:
        return explode_genres(self.items, self.cfg.genre_vocabulary, self.cfg.normalize_genres)

    @cached_property
    def split(self) -> tuple[DataFrame, DataFrame]:
        return hash_split(self.ratings, self.cfg.train_fraction, self.cfg.split_buckets)

    @property
    def train(self) -> DataFrame:
        return self.split[0]

    @property
    def test(self) -> DataFrame:
        return self.split[1]

    @cached_property
    def split_table(self) -> DataFrame:
        """Both sides of the hash split aggregated per (user, item) in one pass (persisted)."""
        return split_pairs(self.ratings, self.cfg.train_fraction, self.cfg.relevance_threshold,
                           self.cfg.split_buckets).persist(_LEVEL)

    @cached_property
    def pairs(self) -> DataFrame:
        return pairs_of(self.split_table)

    @cached_property
    def features(self) -> DataFrame:
        """One row per user, written once and read by every consumer."""
        return stored(clusterable(user_features_from_pairs(self.pairs)), "features")

    @cached_property
    def user_clusters(self) -> DataFrame:
        return assign_by_thresholds(self.features, self.thresholds).select(
            "userId", "cluster", "movies_rated", "avg_rating")

    @cached_property
    def rated(self) -> DataFrame:
        return with_clusters(self.pairs, self.user_clusters).persist(_LEVEL)

    @cached_property
    def scores(self) -> DataFrame:
        return cluster_item_scores(self.rated)

    @cached_property
    def ranked(self) -> DataFrame:
        return rank_items(self.scores).persist(_LEVEL)

    @cached_property
    def longest(self) -> int:
        return longest_history(self.rated)

    @cached_property
    def recommendations(self) -> DataFrame:
        return recommend(self.rated, self.user_clusters, self.scores, self.items, self.cfg.top_n,
                         ranked=self.ranked, longest=self.longest).persist(_LEVEL)

    @cached_property
    def relevant(self) -> DataFrame:
        return relevant_of(self.split_table)

    @cached_property
    def per_user(self) -> DataFrame:
        return per_user_metrics(self.recommendations, self.relevant, self.cfg.top_n)

    @cached_property
    def documents(self) -> DataFrame:
        return pack_documents(self.recommendations)

    @cached_property
    def scaled(self) -> DataFrame:
        return scale_features(self.features).persist(_LEVEL)

    def kmeans(self, k: int, **params):
        model = fit_clusters(self.scaled, k, self.cfg.seed, **params)
        return model, assign_clusters(model, self.scaled)

    def release(self) -> None:
        """Unpersist every table this workload persisted (shared inputs included)."""
        for value in list(self.__dict__.values()):
            for df in (value if isinstance(value, tuple) else (value,)):
                if isinstance(df, DataFrame) and df.storageLevel.useMemory | df.storageLevel.useDisk:
                    df.unpersist()

    def sweep(self, assignments) -> list["TableWorkload"]:
        """One workload per assignment. They share every input that does not depend on the
        clustering, and one join of the pairs with a users table of all assignments."""
        users, columns = self.features, []
        for i, thresholds in enumerate(assignments):
            columns.append(f"cluster_{i}")
            users = assign_by_thresholds(users, thresholds, out=columns[-1])
        tagged = with_clusters(self.pairs, users, tuple(columns)).persist(_LEVEL)
        longest, out = longest_history(tagged), []
        for thresholds, column in zip(assignments, columns):
            other = TableWorkload(self.spark, self.sf_dir, self.cfg, thresholds)
            for name in ("ratings", "items", "split", "split_table", "pairs", "features", "relevant"):
                other.__dict__[name] = getattr(self, name)
            other.__dict__["rated"] = clusters_of(tagged, column)
            other.__dict__["tagged"] = tagged
            other.__dict__["longest"] = longest
            out.append(other)
        return out
