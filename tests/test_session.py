"""Session helpers: shared checkpoint folder, scratch paths, reliable checkpoints."""

import pytest

from segrec.operators import recommend
from segrec.session import checkpoint_root, cut_lineage, scratch_path


def test_scratch_paths_are_unique_and_below_checkpoint_root(spark):
    root = checkpoint_root(spark).rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root) and b.startswith(root)


def test_cut_lineage_keeps_rows_and_drops_lineage(spark):
    df = spark.range(100).selectExpr("id", "id * 2 AS twice").filter("id % 3 = 0")
    cut = cut_lineage(df)
    assert sorted(tuple(r) for r in cut.collect()) == sorted(tuple(r) for r in df.collect())
    assert "Filter" not in cut._jdf.queryExecution().optimizedPlan().toString()


def test_local_scratch_only_for_local_sessions():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def test_stored_tables_are_dropped(spark):
    from segrec import session

    keep = len(session._STORED)
    table = session.stored(spark.range(10), "numbers")
    assert table.count() == 10
    path = session._STORED[-1]
    session.drop_stored(spark, keep)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_recommend_rejects_empty_lists(spark):
    df = spark.createDataFrame([(1, 1, 0)], "userId bigint, movieId bigint, cluster bigint")
    with pytest.raises(ValueError):
        recommend(df, df, df, top_n=0)
