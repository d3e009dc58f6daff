"""The lookup store: same documents as the plain lookup, and only the folders asked for are read."""

import glob
import os

import pytest
from plan_metrics import scans
from pyspark.sql import functions as F

from segrec.operators.served import ServedDocuments, write_served
from segrec.operators.serving import lookup, missing


@pytest.fixture
def docs(spark):
    entry = F.array(F.struct((F.col("user_id") + 1).alias("movie_id"), F.lit("t").alias("movie_title"), F.lit(0.5).alias("score")))
    return spark.range(0, 4000, 2).withColumnRenamed("id", "user_id").select(
        "user_id", (F.col("user_id") % 3).alias("cluster"), entry.alias("recommendations"))


@pytest.fixture
def store(spark, docs, tmp_path):
    write_served(docs, str(tmp_path / "served"), buckets=16)
    return str(tmp_path / "served")


def rows(df):
    return sorted((r.user_id, r.cluster, [tuple(x) for x in r.recommendations]) for r in df.collect())


def test_lookup_equals_the_plain_one(spark, docs, store):
    served = ServedDocuments(spark, store)
    asked = spark.createDataFrame([(i,) for i in (4, 4, 7, None, 3998, -5, 10**12)], "some_id bigint")
    assert served.buckets == 16 and rows(served.documents()) == rows(docs)
    assert rows(served.lookup(asked)) == rows(lookup(docs, asked.withColumnRenamed("some_id", "user_id"))) == rows(lookup(docs, [4, 3998]))
    assert rows(served.lookup([4, 7, 3998, -5])) == rows(lookup(docs, [4, 3998]))
    got = sorted(r.user_id for r in served.missing(asked).collect())
    assert got == [-5, 7, 10**12] == sorted(r.user_id for r in missing(docs, asked).collect() if r.user_id is not None)
    assert rows(served.lookup(spark.range(0, 5000))) == rows(docs)
    assert served.lookup([]).collect() == [] and served.lookup(spark.range(0)).collect() == []


def test_only_the_folders_asked_for_are_read(spark, store):
    served = ServedDocuments(spark, store)
    every = len(glob.glob(f"{store}/buckets=16/bucket=*/*.parquet"))
    for asked in ([4, 3998], spark.createDataFrame([(4,), (3998,)], "user_id bigint")):
        found = served.lookup(asked)
        assert len(found.collect()) == 2
        assert "PartitionFilters: [" in (plan := found._jdf.queryExecution().toString()) and "bucket" in plan
        ((files, _),) = scans(found, "recommendations")
        assert 1 <= files <= 2 < every
    # files of the other folders are not opened at all: broken ones do no harm
    keep = {r.f for r in spark.read.parquet(store).filter("user_id in (4, 3998)").select(F.input_file_name().alias("f")).collect()}
    for path in glob.glob(f"{store}/buckets=16/bucket=*/*.parquet"):
        if not any(f.endswith(os.path.basename(path)) and os.path.dirname(path).rsplit("/", 1)[1] in f for f in keep):
            with open(path, "wb") as f:
                f.write(b"broken")
    assert [r.user_id for r in served.lookup(spark.createDataFrame([(3998,), (4,)], "user_id bigint")).orderBy("user_id").collect()] == [4, 3998]
    with pytest.raises(Exception):
        served.documents().collect()


def test_bloom_filter_skips_row_groups(spark, docs, store):
    # an odd id lies between the even ones of its file: statistics cannot rule it out
    served = ServedDocuments(spark, store)
    skipped = 0
    for i in range(1001, 1041, 2):
        found = served.lookup([i])
        assert found.collect() == []
        ((_, read),) = scans(found, "recommendations")
        skipped += read == 0
    assert skipped >= 18


def test_empty_store_and_bad_count(spark, docs, tmp_path):
    write_served(docs.limit(0), str(tmp_path / "none"))
    served = ServedDocuments(spark, str(tmp_path / "none"))
    assert served.lookup([1]).collect() == [] and served.documents().collect() == []
    assert [r.user_id for r in served.missing(spark.range(2)).orderBy("user_id").collect()] == [0, 1]
    with pytest.raises(ValueError):
        write_served(docs, str(tmp_path / "x"), buckets=0)
