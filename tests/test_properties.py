"""Property tests (Hypothesis): pack/flatten round trip, distributed rank = row_number,
written outputs read back whole."""

import os
import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from segrec.operators import flatten_documents, pack_documents, rank_within_groups
from segrec.sinks import write_outputs

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

recs_strategy = st.lists(
    st.tuples(st.integers(1, 30), st.integers(0, 3), st.integers(1, 200),
              st.one_of(st.none(), st.text(max_size=12)), st.floats(0, 50, allow_nan=False)),
    min_size=1, max_size=40)


@SETTINGS
@given(recs_strategy)
def test_flatten_of_pack_is_identity(spark, rows):
    # one cluster per user, distinct items per user, ranks 1..m in score order
    by_user = {}
    for u, c, m, t, s in rows:
        entry = by_user.setdefault(u, {"cluster": c, "items": {}})
        entry["items"].setdefault(m, (t, s))
    flat = []
    for u, e in by_user.items():
        ordered = sorted(e["items"].items(), key=lambda kv: (-kv[1][1], kv[0]))
        flat += [(u, e["cluster"], m, t, s, i + 1) for i, (m, (t, s)) in enumerate(ordered)]
    df = spark.createDataFrame(flat, "userId bigint, cluster bigint, movieId bigint, title string, "
                                     "recommendation_score double, rank bigint")
    back = sorted(tuple(r) for r in flatten_documents(pack_documents(df)).collect())
    assert back == sorted((u, c, rk, m, t, s) for u, c, m, t, s, rk in flat)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-5, 5)), min_size=1, max_size=120),
       st.integers(1, 7))
def test_distributed_rank_equals_row_number(spark, rows, slices):
    data = [(g, v, i) for i, (g, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "g bigint, v bigint, id bigint")
    order = [F.col("v").desc(), F.col("id").asc()]
    got = {r.id: r.rk for r in rank_within_groups(df, ["g"], order, "rk", num_slices=slices).collect()}
    want = {r.id: r.rk for r in df.withColumn(
        "rk", F.row_number().over(Window.partitionBy("g").orderBy(*order))).collect()}
    assert got == want


def test_write_outputs_partitions_by_k(spark):
    out = tempfile.mkdtemp(prefix="segrec-outputs-")
    tables = {
        "metrics": spark.createDataFrame([(0.1, 3), (0.2, 5)], "precision_at_k double, k bigint"),
        "notes": spark.createDataFrame([("x",)], "note string"),
    }
    paths = write_outputs(tables, out, fmt="parquet")
    assert sorted(p for p in os.listdir(paths[0]) if p.startswith("k=")) == ["k=3", "k=5"]
    back = spark.read.parquet(paths[0]).orderBy("k").collect()
    assert [(r.precision_at_k, r.k) for r in back] == [(0.1, 3), (0.2, 5)]
    assert spark.read.parquet(paths[1]).count() == 1
