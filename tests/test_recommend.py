"""Exact recommender vs the brute-force candidate fan-out on random fixtures, plus ranking."""

import importlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from brute import brute_recommend
from segrec.operators import (
    candidate_counts,
    cluster_item_scores,
    rank_within_groups,
    recommend,
    top_n_per_group,
    with_clusters,
)


def _random_fixture(seed, users=40, items=30, rows=400, k=3, hot_user=True):
    rng = np.random.default_rng(seed)
    u = rng.integers(1, users + 1, rows)
    if hot_user:  # one user holds a third of the rows
        u[: rows // 3] = 1
    m = rng.integers(1, items + 1, rows)
    m[rows // 3: rows // 2] = 7  # a hot item
    r = rng.integers(1, 6, rows).astype(float)
    train = pd.DataFrame({"userId": u, "movieId": m, "rating": r, "timestamp": np.arange(rows)})
    clusters = pd.DataFrame({"userId": np.unique(u)})
    clusters["cluster"] = rng.integers(0, k, len(clusters))
    return train, clusters


@pytest.mark.parametrize("seed,top_n,hint,block_size", [
    (1, 5, None, 4096), (2, 10, None, 3), (3, 3, "merge", 2), (4, 25, "merge", 4), (5, 1, None, 1),
    (6, 4, "shuffle_hash", 5), (7, 6, None, 1024)])
def test_recommend_equals_brute_force(spark, seed, top_n, hint, block_size):
    train_pd, clusters_pd = _random_fixture(seed)
    train = spark.createDataFrame(train_pd)
    clusters = spark.createDataFrame(clusters_pd)
    rated = with_clusters(train, clusters)
    scores = cluster_item_scores(rated)
    recs = recommend(rated, clusters, scores, None, top_n, block_size=block_size, join_hint=hint)
    got = sorted((r.userId, r.rank, r.movieId) for r in recs.collect())
    want = brute_recommend(train_pd, clusters_pd, top_n)
    expected = sorted(zip(want.userId.astype(int), want["rank"].astype(int), want.movieId.astype(int)))
    assert got == expected
    # invariants: no recommended pair was rated, ranks are 1..m contiguous
    seen = set(zip(train_pd.userId, train_pd.movieId))
    assert not any((u, m) in seen for u, _, m in got)
    by_user = {}
    for u, rk, _ in got:
        by_user.setdefault(u, []).append(rk)
    assert all(sorted(v) == list(range(1, len(v) + 1)) and len(v) <= top_n for v in by_user.values())


def test_candidate_counts_match_brute_force(spark):
    train_pd, clusters_pd = _random_fixture(11)
    train = spark.createDataFrame(train_pd)
    clusters = spark.createDataFrame(clusters_pd)
    rated = with_clusters(train, clusters)
    got = {r.userId: r.candidates for r in
           candidate_counts(clusters, cluster_item_scores(rated), rated).collect()}
    want = brute_recommend(train_pd, clusters_pd, 10 ** 6).groupby("userId").size().to_dict()
    assert got == want  # a user without a candidate has no row


def _final_plan(df) -> list[str]:
    from explain_plans import condense, executed

    return condense(executed(df))


def test_large_plan_joins_rated_and_ranked_once(spark):
    import __spark_entry__ as e
    from table_dirs import SF_SMALL

    plan = _final_plan(e.queries()["recommend_topn_large"](spark, SF_SMALL))
    joins = [line for line in plan if "Join" in line]
    assert len([j for j in joins if "[cluster, movieId], [cluster, movieId]" in j]) == 1, plan
    assert len([j for j in joins if "_salt" in j]) == 1, plan
    assert not [j for j in joins if "Broadcast" in j and "cluster" in j], plan


@pytest.mark.parametrize("head_rows", [100_000, 0])
def test_only_the_head_of_a_cluster_meets_the_pairs(spark, monkeypatch, head_rows):
    module = importlib.import_module("segrec.operators.recommend")
    monkeypatch.setattr(module, "HEAD_ROWS", head_rows)
    train_pd, clusters_pd = _random_fixture(11, users=60, items=400, rows=900, hot_user=False)
    clusters = spark.createDataFrame(clusters_pd)
    rated = with_clusters(spark.createDataFrame(train_pd), clusters)
    longest = int(train_pd.drop_duplicates(["userId", "movieId"]).groupby("userId").size().max())
    assert module.longest_history(rated) == longest
    scores = cluster_item_scores(rated)
    head, n = module.head_of(module.rank_items(scores), 4, longest)
    assert n == head.count() <= 3 * (4 + longest) < scores.count()
    setting = "spark.sql.autoBroadcastJoinThreshold"
    usual = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        recs = recommend(rated, clusters, scores, None, 4)
        plan = _final_plan(recs)
        got = sorted((r.userId, r.rank, r.movieId) for r in recs.collect())
    finally:
        spark.conf.set(setting, usual)
    joins = [line for line in plan if "Join" in line and "[cluster, movieId], [cluster, movieId]" in line]
    assert joins and all(("Broadcast" in j) == bool(head_rows) for j in joins), plan
    want = brute_recommend(train_pd, clusters_pd, 4)
    assert got == sorted(zip(want.userId.astype(int), want["rank"].astype(int), want.movieId.astype(int)))


def test_hot_user_is_split(spark, monkeypatch):
    from segrec.session import stored

    hot = spark.range(60_000).selectExpr("IF(id % 2 = 0, 1, id % 97 + 2) AS userId", "id AS movieId",
                                         "3.0D AS rating_sum", "1L AS rating_n", "1L AS rows")
    pairs = hot.repartition(8, "userId", "movieId")
    users = pairs.groupBy("userId").agg(F.sum("rating_n").alias("movies_rated"))
    users = stored(users.withColumn("cluster", F.lit(0)), "users")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        plan = _final_plan(with_clusters(pairs, users))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert any("SortMergeJoin(skew=true)" in line for line in plan), plan


def test_rank_within_groups_matches_row_number(spark):
    rng = np.random.default_rng(7)
    n = 5000
    g = rng.integers(0, 4, n)
    g[: n // 2] = 0  # hot group
    pdf = pd.DataFrame({"g": g, "v": rng.integers(0, 50, n), "id": np.arange(n)})
    df = spark.createDataFrame(pdf).repartition(7)
    order = [F.col("v").desc(), F.col("id").asc()]
    got = rank_within_groups(df, ["g"], order, "rk").select("id", "rk")
    want = df.withColumn("rk2", F.row_number().over(Window.partitionBy("g").orderBy(*order))).select("id", "rk2")
    diff = got.join(want, "id").filter(F.col("rk") != F.col("rk2")).count()
    assert diff == 0 and got.count() == n


def test_top_n_per_group_plans_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    out = top_n_per_group(df, ["g"], [F.col("v").desc()], 2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert sorted(tuple(r) for r in out.select("g", "v").collect()) == [(0, 996), (0, 999), (1, 994), (1, 997),
                                                                       (2, 995), (2, 998)]
