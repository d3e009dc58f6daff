"""Sources, sinks, staging and the lookup store through a file system that is not the local one by name."""

import os

import pytest
from table_dirs import SF_SMALL

from segrec.config import RunConfig
from segrec.files import Files
from segrec.operators.clusters import assign_by_thresholds
from segrec.operators.served import ServedDocuments, write_served
from segrec.plans.pipeline import run_pipeline
from segrec.sinks.staged import committed
from segrec.sources import (
    TABLE_GENRES,
    items_from_tables,
    ratings_from_tables,
    read_documents,
    read_items,
    read_ratings,
    read_recommendations,
    render_items_lines,
    render_ratings_lines,
)


@pytest.fixture
def remote(spark, tmp_path):
    """A folder that Spark reaches as viewfs://lake/data; open() and os.path can't."""
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.lake.link./data", f"file://{tmp_path}")
    return "viewfs://lake/data"


def test_files(spark, remote, tmp_path):
    files = Files(spark)
    files.write_json(f"{remote}/a/x.json", {"é": [1, None]})
    assert files.read_json(f"{remote}/a/x.json") == {"é": [1, None]} and os.path.exists(tmp_path / "a" / "x.json")
    files.replace(f"{remote}/a/x.json", f"{remote}/b/c/y.json")
    assert files.names(f"{remote}/a") == [] and files.names(f"{remote}/b/c") == ["y.json"] and files.names(f"{remote}/none") == []
    assert files.exists(f"{remote}/b/c/y.json") and files.stamps(f"{remote}/b/c")[0][0] == "y.json"
    files.delete(f"{remote}/b")
    assert not files.exists(f"{remote}/b")
    with pytest.raises(Exception):
        files.replace(f"{remote}/missing", f"{remote}/there")


def test_sweep_from_text_to_documents(spark, remote):
    ratings, items = ratings_from_tables(spark, SF_SMALL), items_from_tables(spark, SF_SMALL)
    render_ratings_lines(ratings).write.text(f"{remote}/ratings.dat")
    render_items_lines(items).write.text(f"{remote}/movies.dat")
    read = read_ratings(spark, f"{remote}/ratings.dat"), read_items(spark, f"{remote}/movies.dat", encoding="ISO-8859-1")
    assert read[0].count() == ratings.count() and read[1].count() == items.count()
    cfg = RunConfig(genre_vocabulary=TABLE_GENRES)
    run_pipeline(*read, cfg, out=f"{remote}/out", documents_k="best",
                 assignments={3: lambda f: assign_by_thresholds(f, (25, 40))}).release()
    assert committed(spark, f"{remote}/out")["about"]["k_values"] == [3]
    recs = read_recommendations(spark, f"{remote}/out/recommendations_topn")
    docs = read_documents(spark, f"{remote}/out/documents", unique=True)
    assert docs.count() == recs.select("userId").distinct().count() > 0
    write_served(docs, f"{remote}/served", buckets=8)
    some = docs.select("user_id").limit(5)
    assert ServedDocuments(spark, f"{remote}/served").lookup(some).count() == 5
