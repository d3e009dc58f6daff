"""Staged sweeps: a broken one leaves the last result, and is taken up where it ended."""

import os

import pytest
from table_dirs import SF_SMALL

import segrec.plans.pipeline as pipeline
from segrec.config import RunConfig
from segrec.files import Files
from segrec.operators.clusters import assign_by_thresholds
from segrec.plans.pipeline import run_pipeline
from segrec.sinks.staged import StagedOutput, committed, input_key, recover
from segrec.sources import TABLE_GENRES, items_from_tables, ratings_from_tables

CFG = RunConfig(k_values=(2, 3), genre_vocabulary=TABLE_GENRES)
TABLES = ("user_clusters", "cluster_stats", "cluster_descriptions", "cluster_genres", "top_genres", "recommendations_topn",
          "sample_recommendations_20_users", "per_user_metrics", "metrics")


class Killed(Exception):
    pass


@pytest.fixture
def inputs(spark):
    return ratings_from_tables(spark, SF_SMALL), items_from_tables(spark, SF_SMALL)


def contents(spark, out, ks):
    """Every table of an output folder as sorted rows, doubles rounded."""
    def rows(path):
        norm = lambda v: f"{v:.6f}" if isinstance(v, float) else str(v)
        df = spark.read.parquet(path)
        return sorted(tuple(norm(r[c]) for c in sorted(df.columns)) for r in df.collect())

    found = {f"{t}/k={k}": rows(f"{out}/{t}/k={k}") for t in TABLES for k in ks}
    return found | {"metrics_summary": rows(f"{out}/metrics_summary")}


def break_after(monkeypatch, finished):
    """End the sweep when so many K's are staged; returns the K's whose fit began."""
    fitted, written = [], []
    write, fit = pipeline._write_run, pipeline.fit_sweep

    def counting_fit(scaled, ks, *args, **kwargs):
        fitted.extend(ks)
        return fit(scaled, ks, *args, **kwargs)

    def counting_write(result, *args):
        if len(written) == finished:
            raise Killed
        write(result, *args)
        written.append(result.k)

    monkeypatch.setattr(pipeline, "_write_run", counting_write)
    monkeypatch.setattr(pipeline, "fit_sweep", counting_fit)
    return fitted


def test_broken_sweep_leaves_the_old_result_and_is_resumed(spark, inputs, tmp_path, monkeypatch):
    ratings, items = inputs
    whole, out = str(tmp_path / "whole"), str(tmp_path / "out")
    run_pipeline(ratings, items, CFG, out=whole, fmt="parquet").release()
    expect = contents(spark, whole, CFG.k_values)
    # an older result with another threshold
    older = RunConfig(k_values=CFG.k_values, genre_vocabulary=TABLE_GENRES, relevance_threshold=5.0)
    run_pipeline(ratings, items, older, out=out, fmt="parquet").release()
    old = contents(spark, out, CFG.k_values)
    assert old != expect

    with monkeypatch.context() as m:
        fitted = break_after(m, finished=1)
        with pytest.raises(Killed):
            run_pipeline(ratings, items, CFG, out=out, fmt="parquet")
        assert fitted == [2, 3]
    assert contents(spark, out, CFG.k_values) == old and committed(spark, out)["about"]["k_values"] == [2, 3]

    with monkeypatch.context() as m:
        fitted = break_after(m, finished=9)
        result = run_pipeline(ratings, items, CFG, out=out, fmt="parquet")
        assert fitted == [3]  # no fit for the K that was finished
    assert contents(spark, out, CFG.k_values) == expect
    assert committed(spark, out)["about"]["taken_over"] == [2]
    assert sorted(result.runs) == [2, 3] and result.runs[2].scores is None
    assert result.runs[2].recommendations.count() == len(expect["recommendations_topn/k=2"])
    assert result.best_sample.select("userId").distinct().count() == 20
    assert sorted(r.k for r in result.summary.collect()) == [2, 3]
    assert not os.path.exists(f"{out}/_publish.json") and os.listdir(f"{out}/_staging") == []
    result.release()
    # finished and published: the next one begins anew
    with monkeypatch.context() as m:
        fitted = break_after(m, finished=9)
        run_pipeline(ratings, items, CFG, out=out, fmt="parquet").release()
        assert fitted == [2, 3]


def test_all_runs_finished_before_the_break(spark, inputs, tmp_path, monkeypatch):
    ratings, items = inputs
    out = str(tmp_path / "out")
    with monkeypatch.context() as m:
        m.setattr(StagedOutput, "publish", lambda *a, **k: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            run_pipeline(ratings, items, CFG, out=out, documents_k="best", checkpoint=True)
    assert not os.path.exists(f"{out}/metrics_summary")
    with monkeypatch.context() as m:
        fitted = break_after(m, finished=0)
        result = run_pipeline(ratings, items, CFG, out=out, documents_k="best", checkpoint=True)
        assert fitted == []
    assert spark.read.json(f"{out}/documents").count() == spark.read.json(f"{out}/user_clusters/k=2").count()
    result.release()
    with monkeypatch.context() as m:
        fitted = break_after(m, finished=1)
        with pytest.raises(Killed):
            run_pipeline(ratings, items, CFG, out=out)
    with monkeypatch.context() as m:
        fitted = break_after(m, finished=9)
        run_pipeline(ratings, items, CFG, out=out, resume=False).release()
        assert fitted == [2, 3]


@pytest.mark.parametrize("moves", [0, 1, 3])
def test_publication_broken_off_is_finished_by_the_next_one(spark, tmp_path, moves, monkeypatch):
    out = str(tmp_path)
    names = [f"t{k}/k={i}" for k in range(2) for i in (1, 2)]
    for version in (1, 2):
        stage = StagedOutput(spark, out, f"run{version}")
        for name in names:
            spark.range(version).write.parquet(stage.path(name))
        if version == 1:
            stage.publish(names)
    replace, done = Files.replace, []

    def limited(self, source, target):
        if "tables" in source:
            if len(done) == moves:
                raise Killed
            done.append(target)
        replace(self, source, target)

    with monkeypatch.context() as m:
        m.setattr(Files, "replace", limited)
        with pytest.raises(Killed):
            stage.publish(names, {"version": 2})
    assert [spark.read.parquet(f"{out}/{n}").count() for n in names] == [2] * moves + [1] * (4 - moves)
    assert recover(spark, out) and not recover(spark, out)
    assert [spark.read.parquet(f"{out}/{n}").count() for n in names] == [2] * 4
    assert committed(spark, out)["about"] == {"version": 2} and committed(spark, out)["tables"] == names


def test_tables_of_other_ks_stay(spark, inputs, tmp_path):
    ratings, items = inputs
    out = str(tmp_path)
    cut = lambda *t: lambda f: assign_by_thresholds(f, t)
    run_pipeline(ratings, items, CFG, out=out, assignments={2: cut(32), 3: cut(25, 40)}).release()
    before = spark.read.json(f"{out}/user_clusters/k=3").count()
    result = run_pipeline(ratings, items, CFG, out=out, assignments={2: cut(30)})
    assert spark.read.json(f"{out}/user_clusters/k=3").count() == before
    assert [r.k for r in result.summary.collect()] == [2] and result.runs[2].cost is None
    result.release()


def test_input_key(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(30).write.parquet(path)
    read = lambda: spark.read.parquet(path)
    first = input_key(read(), read().filter("id > 3"))
    assert first == input_key(read(), read().filter("id > 3"))
    assert first != input_key(read(), read().filter("id > 4")) != input_key(read())
    spark.range(30).write.mode("overwrite").parquet(path)
    assert first != input_key(read(), read().filter("id > 3"))
    local = spark.createDataFrame([(1,)], "id int")
    assert input_key(local) != input_key(local)
