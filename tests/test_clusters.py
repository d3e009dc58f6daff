"""K-Means invariants (labels and costs are not golden: they depend on partitioning)."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from table_dirs import SF_SMALL
from segrec.operators import (
    assign_clusters,
    assign_nearest,
    describe_clusters,
    fit_clusters,
    kmeans_invariants,
    scale_features,
    training_cost,
)
from segrec.plans.workload import TableWorkload


@pytest.fixture(scope="module")
def scaled(spark):
    return TableWorkload(spark, SF_SMALL).scaled.cache()


def test_every_user_once_at_nearest_centre(spark, scaled):
    model = fit_clusters(scaled, 5, seed=42)
    uc = assign_clusters(model, scaled)
    users = scaled.count()
    assert uc.count() == users and uc.select("userId").distinct().count() == users
    assert uc.select("cluster").distinct().count() <= 5
    inv = kmeans_invariants(model, scaled).collect()[0]
    assert inv.users == users and inv.all_nearest and inv.sizes_sum_ok


def test_cost_not_above_summary(spark, scaled):
    for k in (3, 5, 8):
        model = fit_clusters(scaled, k, seed=42)
        centers = [list(map(float, c)) for c in model.clusterCenters()]
        arr = vector_to_array("features")
        dists = [(arr[0] - c[0]) ** 2 + (arr[1] - c[1]) ** 2 for c in centers]
        recomputed = scaled.select(F.least(*dists).alias("d")).agg(F.sum("d")).collect()[0][0]
        assert recomputed <= training_cost(model) + 1e-6


def test_k_must_be_at_least_two(scaled):
    with pytest.raises(ValueError):
        fit_clusters(scaled, 1)


def test_scaler_constant_column_gives_zero(spark):
    df = spark.createDataFrame([(1, 5, 1.0), (2, 5, 3.0)], "userId bigint, movies_rated bigint, avg_rating double")
    out = scale_features(df).select(vector_to_array("features").alias("f")).collect()
    assert all(r.f[0] == 0.0 for r in out)


def test_assign_nearest_first_on_ties(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 1.0)], "userId bigint, a double, b double")
    out = assign_nearest(df, [(0.0, 0.0), (2.0, 2.0), (0.0, 0.0)], ["a", "b"]).orderBy("userId").collect()
    assert [r.cluster for r in out] == [0, 0]


def test_describe_labels(spark):
    stats = spark.createDataFrame([(0, 350.0, 4.1), (1, 150.0, 3.0), (2, 20.0, 3.5)],
                                  "cluster bigint, avg_movies_rated double, avg_user_rating double")
    got = {r.cluster: r.description for r in describe_clusters(stats).collect()}
    assert got[0] == "Usuario muy activo con perfil de calificacion muy positivo"
    assert got[1] == "Usuario activo con perfil de calificacion mas critico"
    assert got[2] == "Usuario ocasional o moderado con perfil de calificacion intermedio"


def test_parallel_sweep_equals_sequential(spark, scaled):
    from segrec.operators import fit_sweep

    seq = fit_sweep(scaled, (3, 5), seed=42, parallelism=1)
    par = fit_sweep(scaled, (3, 5), seed=42, parallelism=2)
    for k in (3, 5):
        assert [list(c) for c in seq[k].clusterCenters()] == [list(c) for c in par[k].clusterCenters()]


def test_describe_label_boundaries(spark):
    # activity: > 300 very active, > 100 active; rating: >= 4.0 very positive, < 3.2 critical
    stats = spark.createDataFrame([(0, 300.0, 4.0), (1, 100.0, 3.2), (2, 300.5, 3.1999), (3, 100.5, 3.99)],
                                  "cluster bigint, avg_movies_rated double, avg_user_rating double")
    got = {r.cluster: (r.activity, r.rating_profile) for r in describe_clusters(stats).collect()}
    assert got[0] == ("Usuario activo", "muy positivo")
    assert got[1] == ("Usuario ocasional o moderado", "intermedio")
    assert got[2] == ("Usuario muy activo", "mas critico")
    assert got[3] == ("Usuario activo", "intermedio")
