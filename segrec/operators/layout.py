"""Storage by user: user-item pairs in hash buckets that joins and aggregates by user reuse.

A sweep joins the pairs with the clusters of its users, and aggregates them by user, again and
again. ``UserLayout.store`` shuffles them by user once and writes the result bucketed and
sorted, so those later plans read it as it is: no exchange of the pairs, for any K.

A bucket is one task, which is what a hot user must not be. Users of more than ``hot_rows`` pairs
(at most pairs / hot_rows of them) are therefore kept apart, in a plain table: it is shuffled
for its join like any other, where AQE splits a user's partition over many tasks, and its
aggregates are combined in the map tasks.

Buckets are known to Spark through the catalog only, so the tables have names there.
``drop`` (or leaving the ``with`` block) takes the names and the files away; both belong to the layout's owner.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segrec.files import Files
from segrec.operators.scoring import user_features_from_pairs, with_clusters
from segrec.session import scratch_path

HOT_ROWS = 1_000_000


class UserLayout:
    """Pairs stored by user; made by ``store``."""

    def __init__(self, cold: DataFrame, hot: DataFrame, buckets: int, names: list[str], paths: list[str]):
        self.cold, self.hot, self.buckets = cold, hot, buckets
        self._names, self._paths, self._spark = names, paths, cold.sparkSession

    @classmethod
    def store(cls, pairs: DataFrame, buckets: int, hot_rows: int = HOT_ROWS) -> UserLayout:
        """Write ``pairs`` (userId and any columns) in ``buckets``; choose the count so that a bucket is
        a good task (some hundred MB) and at most ``spark.sql.sources.bucketing.maxBuckets``."""
        spark = pairs.sparkSession
        most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
        if not 1 <= buckets <= most:
            raise ValueError(f"buckets must be between 1 and {most}")
        layout = cls(pairs, pairs, buckets, [], [])
        pairs = layout._plain(pairs, "pairs")
        # counts are combined in the map tasks: a hot user is a few rows here
        users = layout._plain(pairs.groupBy("userId").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_rows).select("userId"), "hot-users")
        layout.hot = layout._plain(pairs.join(users, "userId", "left_semi"), "hot-pairs")
        layout.cold = layout.bucketed(pairs.join(users, "userId", "left_anti"), "pairs")
        return layout

    def _plain(self, df: DataFrame, name: str) -> DataFrame:
        self._paths.append(scratch_path(self._spark, name))
        df.write.parquet(self._paths[-1])
        return self._spark.read.schema(df.schema).parquet(self._paths[-1])

    def bucketed(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` (with userId) written in the same buckets, for joins without an exchange of either side."""
        self._paths.append(scratch_path(self._spark, name))
        self._names.append(f"segrec_{name}_{uuid.uuid4().hex}")
        # the shuffle has the buckets' own hash, so each task writes one file
        (df.repartition(self.buckets, "userId").write.option("path", self._paths[-1])
         .bucketBy(self.buckets, "userId").sortBy("userId").saveAsTable(self._names[-1]))
        return self._spark.table(self._names[-1])

    def pairs(self) -> DataFrame:
        return self.cold.unionByName(self.hot)

    def features(self) -> DataFrame:
        """``user_features_from_pairs``: the stored buckets are aggregated where they are read."""
        return user_features_from_pairs(self.cold).unionByName(user_features_from_pairs(self.hot))

    def with_clusters(self, users: DataFrame, cluster_cols: tuple[str, ...] = ("cluster",)) -> DataFrame:
        """``scoring.with_clusters`` of the stored pairs.

        ``users`` (one row per user, a table that was written) are put in the same buckets once. Hot users
        meet the plain table: against a bucketed one only their side would be shuffled, into its
        buckets, and AQE can split a partition only where both sides are."""
        same = self.bucketed(users.select("userId", *cluster_cols), "users")
        return with_clusters(self.cold, same, cluster_cols).unionByName(with_clusters(self.hot, users, cluster_cols))

    def drop(self) -> None:
        for name in self._names:
            self._spark.sql(f"DROP TABLE IF EXISTS {name}")
        files = Files(self._spark)
        for path in self._paths:
            files.delete(path)
        self._names.clear()
        self._paths.clear()

    def __enter__(self) -> UserLayout:
        return self

    def __exit__(self, *_) -> None:
        self.drop()


__all__ = ["HOT_ROWS", "UserLayout"]
