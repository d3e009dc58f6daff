"""K-Means clustering of users, assignment with given centres, cluster descriptions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segrec.functions.expressions import (
    activity_label,
    argmin,
    describe,
    rating_label,
    squared_distance,
    threshold_bucket,
)


def fit_clusters(scaled: DataFrame, k: int, seed: int = 42, features_col: str = "features",
                 **params) -> KMeansModel:
    """Spark ML K-Means (k-means||, 20 iterations, tol 1e-4 unless overridden)."""
    if k < 2:
        raise ValueError("k must be >= 2")
    return KMeans(featuresCol=features_col, k=k, seed=seed, **params).fit(scaled)


def fit_sweep(scaled: DataFrame, ks: Sequence[int], seed: int = 42, features_col: str = "features",
              parallelism: int = 1) -> dict[int, KMeansModel]:
    """One K-Means model per k. With ``parallelism`` > 1 the fits are submitted from a thread
    pool (as Spark ML's CrossValidator does), so their small per-iteration jobs share the
    cluster instead of running one after another; models do not depend on the order.
    ``scaled`` should be persisted; it is filled first, or else each fit would compute it."""
    ks = list(dict.fromkeys(ks))
    if parallelism > 1 and (scaled.storageLevel.useMemory or scaled.storageLevel.useDisk):
        scaled.count()
    if parallelism <= 1 or len(ks) == 1:
        return {k: fit_clusters(scaled, k, seed, features_col) for k in ks}
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=min(parallelism, len(ks))) as pool:
        futures = {k: pool.submit(fit_clusters, scaled, k, seed, features_col) for k in ks}
        return {k: f.result() for k, f in futures.items()}


def assign_clusters(model: KMeansModel, scaled: DataFrame) -> DataFrame:
    """(userId, cluster, movies_rated, avg_rating): nearest centre per user (map-only)."""
    return model.transform(scaled).select(
        "userId", F.col("prediction").cast("bigint").alias("cluster"), "movies_rated", "avg_rating")


def training_cost(model: KMeansModel) -> float:
    return float(model.summary.trainingCost)


def within_cluster_squares(assigned: DataFrame, cluster_col: str = "cluster", features_col: str = "features",
                           dims: int = 2) -> DataFrame:
    """One row (clusters, users, squares): the sum of squared distances of the rows to the mean of
    their cluster, from the assignment alone, without model or centres.

    One aggregate per cluster, combined in the map tasks. Variances are merged as (count, mean, squares
    around the mean), so nothing is lost in a difference of large sums."""
    arr = vector_to_array(F.col(features_col))
    spread = sum((F.var_pop(arr[i]) for i in range(dims)), F.lit(0.0))
    per_cluster = assigned.groupBy(cluster_col).agg(F.count(F.lit(1)).alias("_n"), (F.count(F.lit(1)) * spread).alias("_s"))
    return per_cluster.agg(F.count(F.lit(1)).alias("clusters"), F.coalesce(F.sum("_n"), F.lit(0)).alias("users"),
                           F.coalesce(F.sum("_s"), F.lit(0.0)).alias("squares"))


def cost_agreement(models: Mapping[int, KMeansModel], scaled: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Per K of a sweep, in its order: k, users, training_cost (of the model), squares (of its assignment),
    cost_agrees, cost_falls.

    K-Means reports the cost around the centres that its last step started from; the assignment's own
    means can only be nearer, so ``cost_agrees`` if the squares are at most that cost and not more than
    ``tolerance`` below it. ``cost_falls`` if no smaller K has smaller squares."""
    rows = None
    for ordinal, (k, model) in enumerate(models.items()):
        squares = within_cluster_squares(model.transform(scaled), "prediction")
        squares = squares.select(F.lit(ordinal).alias("ordinal"), F.lit(k).cast("bigint").alias("k"), "users",
                                 F.lit(training_cost(model)).alias("training_cost"), "squares")
        rows = squares if rows is None else rows.unionByName(squares)
    smaller = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)  # one row per K
    agrees = F.col("squares").between(F.col("training_cost") * (1 - tolerance) - 1e-9, F.col("training_cost") * (1 + 1e-9) + 1e-9)
    falls = F.coalesce(F.col("squares") <= F.min("squares").over(smaller), F.lit(True))
    return rows.withColumns({"cost_agrees": agrees, "cost_falls": falls}).orderBy("ordinal").drop("ordinal")


def assign_nearest(df: DataFrame, centers: Sequence[Sequence[float]], cols: Sequence[str],
                   out: str = "cluster") -> DataFrame:
    """Nearest of the given centres by squared Euclidean distance over ``cols`` (first centre
    on ties). The centres are literals in one expression: no join, no shuffle."""
    values = [F.col(c) for c in cols]
    dists = [squared_distance(values, center) for center in centers]
    return df.withColumn(out, argmin(dists))


def assign_by_thresholds(user_features: DataFrame, thresholds: Sequence[float],
                         col: str = "movies_rated", out: str = "cluster") -> DataFrame:
    """Deterministic stand-in for K-Means: cluster = number of thresholds below ``col``
    (len(thresholds)+1 clusters). Used to inject a known assignment."""
    return user_features.withColumn(out, threshold_bucket(col, thresholds))


def kmeans_invariants(model: KMeansModel, scaled: DataFrame, features_col: str = "features",
                      tolerance: float = 1e-9) -> DataFrame:
    """One row: users, all_nearest (every user sits at its nearest centre), sizes_sum_ok
    (cluster sizes add up to the users). The k centres come from the fitted model."""
    centers = [list(map(float, c)) for c in model.clusterCenters()]
    arr = vector_to_array(F.col(features_col))
    dim = len(centers[0])
    values = [arr[i] for i in range(dim)]
    dists = F.array(*[squared_distance(values, c) for c in centers])
    assigned = model.transform(scaled).select(
        F.col("prediction").cast("int").alias("p"), dists.alias("d"))
    checked = assigned.select(
        "p", (F.element_at("d", F.col("p") + 1) <= F.array_min("d") + F.lit(tolerance)).alias("ok"))
    sizes = checked.groupBy("p").agg(F.count(F.lit(1)).alias("size"))
    size_total = sizes.select(F.sum("size")).scalar()
    return checked.agg(
        F.count(F.lit(1)).alias("users"),
        F.bool_and("ok").alias("all_nearest"),
    ).withColumn("sizes_sum_ok", F.col("users") == size_total)


def describe_clusters(stats: DataFrame, activity: tuple[float, float] = (100, 300),
                      rating: tuple[float, float] = (3.2, 4.0)) -> DataFrame:
    """Adds activity, rating_profile and the joined description to ``cluster_stats`` rows."""
    return (stats
            .withColumn("activity", activity_label("avg_movies_rated", activity))
            .withColumn("rating_profile", rating_label("avg_user_rating", rating))
            .withColumn("description", describe(F.col("activity"), F.col("rating_profile"))))
