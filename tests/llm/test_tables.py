from segrec.llm import quality, substring
from segrec.llm.common import bucketed


def test_buckets_stay_below_sparks_bound_and_leave_no_name(spark):
    setting = "spark.sql.sources.bucketing.maxBuckets"
    before = {t.name for t in spark.catalog.listTables()}
    usual = spark.conf.get(setting)
    spark.conf.set(setting, "3")
    try:
        table = bucketed(spark.range(100).selectExpr("id % 20 AS key", "id"), "t", "key", 50)
        assert sorted(r["count"] for r in table.groupBy("key").count().collect()) == [5] * 20
        plan = table.groupBy("key").count()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "out of 3" in plan
        # several chunks and shards to a bucket change nothing
        texts = [" ".join(f"w{(i * 7 + k) % 211}" for k in range(60)) for i in range(40)]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
        labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
        few = (substring.remove_repeats(docs, width=10, chunk_bytes=500).select("row.doc_id", "n_removed"),
               quality.score_documents(docs.selectExpr("*", "'en' AS lang"), labels, chunk_bytes=500).selectExpr("row.doc_id", "round(perplexity, 6) AS p"))
        few = [sorted(map(tuple, df.collect())) for df in few]
    finally:
        spark.conf.set(setting, usual)
    many = (substring.remove_repeats(docs, width=10, chunk_bytes=500).select("row.doc_id", "n_removed"),
            quality.score_documents(docs.selectExpr("*", "'en' AS lang"), labels, chunk_bytes=500).selectExpr("row.doc_id", "round(perplexity, 6) AS p"))
    assert few == [sorted(map(tuple, df.collect())) for df in many]
    assert {t.name for t in spark.catalog.listTables()} == before
