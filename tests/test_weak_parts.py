"""Costs from assignments, vocabularies as tables, sketch profiles, whole-file column checks."""

import os
import random

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F
from table_dirs import SF_SMALL

from segrec.operators.clusters import cost_agreement, fit_sweep, within_cluster_squares
from segrec.operators.prepare import explode_genres
from segrec.operators.sketches import error_bound, sketch_loads, sketch_profile, store_sketches, stored_sketches
from segrec.plans.workload import TableWorkload
from segrec.sources import read_recommendations


def test_within_cluster_squares(spark):
    rng = random.Random(5)
    points = [(rng.randrange(4), 1e6 + rng.random(), rng.gauss(0, 3)) for _ in range(300)] + [(9, 5.0, 5.0)]
    df = spark.createDataFrame(points, "cluster int, x double, y double").withColumn("features", array_to_vector(F.array("x", "y")))
    expect = 0.0
    for c in {p[0] for p in points}:
        members = [p[1:] for p in points if p[0] == c]
        means = [sum(m[i] for m in members) / len(members) for i in (0, 1)]
        expect += sum((m[i] - means[i]) ** 2 for m in members for i in (0, 1))
    row = within_cluster_squares(df).first()
    assert (row.clusters, row.users) == (5, 301) and row.squares == pytest.approx(expect, rel=1e-7)
    none = within_cluster_squares(df.limit(0)).first()
    assert (none.clusters, none.users, none.squares) == (0, 0, 0.0)


def test_cost_agreement_sees_a_wrong_cost(spark):
    class Wrong:
        """A model that reports another cost than its assignment has."""

        def __init__(self, model, factor):
            self.transform = model.transform
            self.summary = type("Summary", (), {"trainingCost": model.summary.trainingCost * factor})

    w = TableWorkload(spark, SF_SMALL)
    models = fit_sweep(w.scaled, (8, 3, 5))
    rows = cost_agreement(models, w.scaled).collect()
    assert [r.k for r in rows] == [8, 3, 5] and all(r.cost_agrees and r.cost_falls for r in rows)
    for factor in (0.9, 1.1, 0.0):
        assert not cost_agreement({3: Wrong(models[3], factor)}, w.scaled).first().cost_agrees
    # the labels of K = 3 under the name of a larger K do not fall
    assert [r.cost_falls for r in cost_agreement({5: models[5], 9: models[3]}, w.scaled).collect()] == [True, False]
    w.release()


def test_vocabulary_as_a_table(spark):
    items = spark.createDataFrame([(1, "Action|War|Sci-Fi"), (2, None), (3, ""), (4, "War|War"), (5, "Drama")], "movieId bigint, genres string")
    words = ["War", "Action", "SciFi", "missing"]
    table = spark.createDataFrame([(w,) for w in [*words, "War", None]], "genres string")
    for normalize in (False, True):
        rows = lambda v: sorted(map(tuple, explode_genres(items, v, normalize).collect()))
        assert rows(table) == rows(words)
    many = spark.range(200_000).select(F.concat(F.lit("w"), "id").alias("w")).unionByName(table.toDF("w"))
    got = explode_genres(items, many)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, explode_genres(items, words).collect()))
    assert "LeftSemi" in got._jdf.queryExecution().optimizedPlan().toString()
    assert explode_genres(items, table.limit(0)).count() == 0


@pytest.fixture
def ratings(spark):
    # a load holds two thirds of all rows, users return in every load
    return spark.range(60_000).select((F.col("id") % 7000).alias("userId"), (F.col("id") * 7 % 900).alias("movieId"),
                                      F.when(F.col("id") % 3 > 0, "2024").when(F.col("id") % 300 > 0, "2025").alias("year"))


def test_sketch_profile_is_merged_and_not_rescanned(spark, ratings, tmp_path):
    path = str(tmp_path / "profile")
    loads = sketch_loads(ratings, "year")
    assert {r.load: r.ratings_rows for r in loads.collect()} == {"2024": 40_000, "2025": 19_800, "none": 200}
    for load in ("2024", "2025", "none", "2024"):  # one load twice: replaced
        store_sketches(loads.filter(F.col("load") == load), path)
    stored = stored_sketches(spark, path)
    row = sketch_profile(stored).first()
    assert (row.loads, row.ratings_rows) == (3, 60_000)
    assert abs(row.distinct_users - 7000) <= error_bound() * 7000 and abs(row.distinct_items - 900) <= error_bound() * 900
    assert row == sketch_profile(sketch_loads(ratings, "year")).first()
    # the merged profile reads sketches alone
    files = {os.path.dirname(f).rsplit("/", 1)[1] for f in stored.inputFiles()}
    assert files == {"load=2024", "load=2025", "load=none"}


@pytest.mark.parametrize("precision", [8, 12, 16])
def test_error_bound_holds(spark, precision):
    for n in (10, 1000, 100_000):
        df = spark.range(n).select(F.col("id").alias("userId"), (F.col("id") * 31).alias("movieId"), F.lit("a").alias("l"))
        row = sketch_profile(sketch_loads(df, "l", precision)).first()
        assert abs(row.distinct_users - n) <= max(1, error_bound(precision) * n)


def test_sketch_profile_of_nothing(spark, ratings):
    row = sketch_profile(sketch_loads(ratings.limit(0), "year")).first()
    assert tuple(row) == (0, 0, 0, 0)
    with pytest.raises(ValueError):
        sketch_loads(ratings, "year", 3)


def test_late_titles_do_not_fail_the_column_check(spark, tmp_path):
    lines = [{"userId": k, "cluster": 0, "movieId": k, "recommendation_score": 1.0} for k in range(3000)]
    df = spark.createDataFrame([(x["userId"], 0, x["movieId"], "t" if x["userId"] == 2999 else None, 1.0) for x in lines],
                               "userId bigint, cluster bigint, movieId bigint, title string, recommendation_score double").coalesce(1)
    df.write.json(str(tmp_path / "late"))
    assert read_recommendations(spark, str(tmp_path / "late")).count() == 3000
    df.drop("title").write.json(str(tmp_path / "none"))
    with pytest.raises(ValueError, match="title"):
        read_recommendations(spark, str(tmp_path / "none"))
    df.limit(0).write.json(str(tmp_path / "empty"))
    assert read_recommendations(spark, str(tmp_path / "empty")).count() == 0
