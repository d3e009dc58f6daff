"""Brute-force pandas reference implementations for small fixtures (the full user x item
candidate fan-out, which the library never builds)."""

from __future__ import annotations

import math

import pandas as pd


def brute_scores(train: pd.DataFrame, clusters: pd.DataFrame) -> pd.DataFrame:
    rated = train.merge(clusters[["userId", "cluster"]], on="userId")
    g = rated.groupby(["cluster", "movieId"])["rating"]
    out = pd.DataFrame({"cluster_avg_movie_rating": g.mean(), "cluster_rating_count": g.count()}).reset_index()
    out["recommendation_score"] = [a * math.log1p(n) for a, n in
                                   zip(out.cluster_avg_movie_rating, out.cluster_rating_count)]
    return out


def brute_recommend(train: pd.DataFrame, clusters: pd.DataFrame, top_n: int) -> pd.DataFrame:
    scores = brute_scores(train, clusters)
    cand = clusters[["userId", "cluster"]].merge(scores, on="cluster")
    seen = train[["userId", "movieId"]].drop_duplicates().assign(_seen=True)
    cand = cand.merge(seen, on=["userId", "movieId"], how="left")
    cand = cand[cand["_seen"].isna()].drop(columns="_seen")
    cand = cand.sort_values(["userId", "recommendation_score", "cluster_rating_count", "movieId"],
                            ascending=[True, False, False, True])
    cand["rank"] = cand.groupby("userId").cumcount() + 1
    return cand[cand["rank"] <= top_n].reset_index(drop=True)
