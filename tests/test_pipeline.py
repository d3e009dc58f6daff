"""The whole sweep on the smallest tables, written and read back."""

import os
import tempfile

from pyspark.sql import functions as F

from table_dirs import SF_SMALL
from segrec.config import RunConfig
from segrec.plans.pipeline import run_pipeline
from segrec.sources import TABLE_GENRES, items_from_tables, ratings_from_tables, read_recommendations


def test_run_pipeline_writes_outputs(spark):
    out = tempfile.mkdtemp(prefix="segrec-out-")
    cfg = RunConfig(k_values=(3, 5), genre_vocabulary=TABLE_GENRES)
    res = run_pipeline(ratings_from_tables(spark, SF_SMALL), items_from_tables(spark, SF_SMALL), cfg,
                       out=out, checkpoint=True)
    summary = res.summary.collect()
    assert [r.k for r in summary] and sorted(r.k for r in summary) == [3, 5]
    assert res.best.count() == 1
    assert sorted(res.runs) == [3, 5]
    best = res.best.first()["k"]
    run = res.runs[best]
    assert 0 < run.cluster_descriptions.count() <= best and run.top_genres.count() > 0
    assert res.best_sample.select("userId").distinct().count() == 20
    assert run.recommendations.count() == spark.read.json(f"{out}/recommendations_topn/k={best}").count()
    res.release()
    assert not any(df.storageLevel.useMemory for df in (run.recommendations, run.scores, run.per_user_metrics))
    for name in ("cluster_descriptions", "top_genres", "quarantine"):
        assert os.path.isdir(os.path.join(out, name)), name
    for name in ("user_clusters", "cluster_stats", "cluster_genres", "recommendations_topn",
                 "sample_recommendations_20_users", "per_user_metrics", "metrics", "metrics_summary"):
        assert os.path.isdir(os.path.join(out, name)), name
    recs = read_recommendations(spark, os.path.join(out, "recommendations_topn"))
    assert sorted(r.k for r in recs.select("k").distinct().collect()) == [3, 5]
    per_k = recs.groupBy("k", "userId").agg(F.max("rank").alias("m"))
    assert per_k.filter(F.col("m") > 10).count() == 0
    # pruning on the partition column
    plan = recs.filter(F.col("k") == 3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
