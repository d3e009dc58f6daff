"""The command line on `::` text files rendered from the smallest tables (random split)."""

import os
import tempfile

from table_dirs import SF_SMALL
from segrec.plans import cli
from segrec.sources import (
    items_from_tables,
    ratings_from_tables,
    read_documents,
    read_recommendations,
    render_items_lines,
    render_ratings_lines,
)


def test_cli_on_text_files(spark):
    data = tempfile.mkdtemp(prefix="segrec-dat-")
    render_ratings_lines(ratings_from_tables(spark, SF_SMALL)).coalesce(2).write.text(
        os.path.join(data, "ratings.dat"))
    render_items_lines(items_from_tables(spark, SF_SMALL)).coalesce(1).write.text(
        os.path.join(data, "movies.dat"))
    out = tempfile.mkdtemp(prefix="segrec-cli-")
    cli.main(["--dataset-path", data, "--output-dir", out, "--k-values", "3,5", "--top-n", "5",
              "--split", "random", "--items-encoding", "UTF-8", "--documents-k", "best"], stop=False)
    from pyspark.sql import SparkSession

    s = SparkSession.builder.getOrCreate()
    recs = read_recommendations(s, os.path.join(out, "recommendations_topn"))
    assert recs.count() > 0
    assert recs.agg({"rank": "max"}).collect()[0][0] <= 5
    summary = s.read.json(os.path.join(out, "metrics_summary")).collect()
    assert sorted(r.k for r in summary) == [3, 5]
    best = min(summary, key=lambda r: (-(r.precision_at_k or 0), [3, 5].index(r.k)))  # first K wins ties
    docs = read_documents(s, os.path.join(out, "documents"))
    users = recs.filter(recs.k == best.k).select("userId").distinct().count()
    assert docs.count() == users
