"""Golden anchors at sf0.01 (computed independently with DuckDB, listed in FIXTURES.md)."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as e
from table_dirs import SF_MID


@pytest.fixture(scope="module")
def q(spark):
    return lambda name: e.queries()[name](spark, SF_MID)


def test_split_and_profile_anchors(q):
    assert tuple(q("split_profile").first()) == (48002, 11998)
    p = q("profile").first()
    assert (p.ratings_rows, p.distinct_users, p.distinct_items) == (60000, 1500, 2000)
    hist = [tuple(r) for r in q("rating_distribution").collect()]
    assert hist == [(1.0, 11929), (2.0, 12017), (3.0, 11883), (4.0, 12157), (5.0, 12014)]


def test_cluster_anchors(q):
    rows = [tuple(r) for r in q("cluster_stats").orderBy("cluster").collect()]
    assert rows == [(0, 18.982418, 2.99848, 455), (1, 32.700422, 3.0005, 711), (2, 48.248503, 3.015975, 334)]


def test_recommendation_and_metric_anchors(q):
    recs = q("recommend_topn")
    assert recs.count() == 15000 and recs.select("userId").distinct().count() == 1500
    assert tuple(q("global_metrics").first()) == (0.002186, 0.006043, 1418)
    assert q("per_user_metrics").agg(F.sum("hits")).first()[0] == 31
