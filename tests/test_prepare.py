"""Splits, profile, configuration."""

import pytest
from pyspark.sql import functions as F

from table_dirs import SF_SMALL
from segrec.config import RunConfig, parse_k_values
from segrec.operators import hash_split, profile, rating_distribution, split_profile
from segrec.sources import items_from_tables, ratings_from_tables


def test_hash_split_is_layout_independent(spark):
    ratings = ratings_from_tables(spark, SF_SMALL)
    a, _ = hash_split(ratings)
    b, _ = hash_split(ratings.repartition(3))
    c, _ = hash_split(ratings.coalesce(1))
    key = ["userId", "movieId", "timestamp", "rating"]
    rows = [sorted(tuple(r) for r in x.select(*key).collect()) for x in (a, b, c)]
    assert rows[0] == rows[1] == rows[2]


def test_split_partitions_all_rows(spark):
    ratings = ratings_from_tables(spark, SF_SMALL)
    train, test = hash_split(ratings)
    sp = split_profile(train, test).collect()[0]
    assert sp.train_rows + sp.test_rows == ratings.count()
    assert 0.75 < sp.train_rows / (sp.train_rows + sp.test_rows) < 0.85


def test_profile_and_histogram(spark):
    ratings = ratings_from_tables(spark, SF_SMALL)
    items = items_from_tables(spark, SF_SMALL)
    p = profile(ratings, items).collect()[0]
    assert p.ratings_rows == ratings.count()
    assert p.distinct_users == ratings.select("userId").distinct().count()
    assert p.item_rows == items.count()
    approx = profile(ratings, items, approx=True).collect()[0]
    assert abs(approx.distinct_users - p.distinct_users) <= 0.05 * p.distinct_users
    hist = rating_distribution(ratings).collect()
    assert [r.rating for r in hist] == [1.0, 2.0, 3.0, 4.0, 5.0]
    assert sum(r["count"] for r in hist) == p.ratings_rows


def test_split_bucket_no_overflow(spark):
    from segrec.functions import split_bucket

    big = spark.createDataFrame([(4_000_000_000_000, 9_000_000_000_000, 2_000_000_000)],
                                "u bigint, m bigint, t bigint")
    val = big.select(split_bucket("u", "m", "t").alias("b")).collect()[0].b
    assert val == ((4_000_000_000_000 * 2654435761 + 9_000_000_000_000 * 40503 + 2_000_000_000) % 1000003) % 10


def test_split_is_never_negative_or_rounded(spark):
    ids = spark.range(10_000).selectExpr("-id - 1 AS userId", "-id * 7 AS movieId", "id AS timestamp", "1.0D AS rating")
    train, test = hash_split(ids)
    assert 0.77 < train.count() / 10_000 < 0.83 and test.count() == 10_000 - train.count()
    train, _ = hash_split(ids, 0.75, buckets=100)
    assert 0.72 < train.count() / 10_000 < 0.78
    for fraction in (0.75, 0.84, 0.96):
        with pytest.raises(ValueError):
            hash_split(ids, fraction)
        with pytest.raises(ValueError):
            RunConfig(train_fraction=fraction)
    assert RunConfig(train_fraction=0.75, split_buckets=100).split_buckets == 100


def test_random_split_sides_are_disjoint_and_complete(spark):
    from segrec.operators import random_split

    rows = spark.range(5000).withColumn("x", F.rand()).repartition(7)  # a source that differs on every read
    train, test = random_split(rows, (0.8, 0.2), 42)
    a, b = ({r.id for r in x.collect()} for x in (train, test))
    assert not a & b and len(a) + len(b) == 5000 and 0.75 < len(a) / 5000 < 0.85


def test_user_features_are_not_coalesced(spark):
    from segrec.plans.workload import TableWorkload
    from segrec.operators.scoring import user_features_from_pairs

    w = TableWorkload(spark, SF_SMALL)
    plan = user_features_from_pairs(w.pairs)._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan
    assert "Aggregate" not in w.scaled._jdf.queryExecution().optimizedPlan().toString()  # reads the stored users


def test_config():
    assert parse_k_values(" 3, 5,,8 ") == (3, 5, 8)
    with pytest.raises(ValueError):
        RunConfig(k_values=(1,))
    with pytest.raises(ValueError):
        RunConfig(split="other")


def test_ratings_view_types(spark):
    df = ratings_from_tables(spark, SF_SMALL)
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "bigint", "double", "bigint"]
    assert df.filter(F.col("rating").isNull()).count() == 0


def test_workload_release_unpersists(spark):
    from segrec.plans.workload import TableWorkload

    w = TableWorkload(spark, SF_SMALL)
    w.recommendations.count()
    assert w.split_table.storageLevel.useMemory and w.recommendations.storageLevel.useMemory
    w.release()
    assert not w.split_table.storageLevel.useMemory and not w.recommendations.storageLevel.useMemory


def test_split_pairs_equals_two_pass(spark):
    from segrec.operators.evaluate import relevant_items
    from segrec.operators.scoring import pairs_of, relevant_of, split_pairs, user_item_pairs

    ratings = ratings_from_tables(spark, SF_SMALL)
    train, test = hash_split(ratings)
    split = split_pairs(ratings)
    one = sorted(tuple(r) for r in pairs_of(split).collect())
    two = sorted(tuple(r) for r in user_item_pairs(train).collect())
    assert one == two
    assert sorted(tuple(r) for r in relevant_of(split).collect()) == \
        sorted(tuple(r) for r in relevant_items(test, 4.0).collect())
