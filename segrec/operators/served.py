"""Served documents stored for lookups by id.

``write_served`` lays documents out in folders by a hash of the user id
(``buckets=<n>/bucket=<i>/``), sorted by user, with a Parquet bloom filter on the id. A lookup
reads the folders that its ids fall into and no others: a list of ids gives literal folder
numbers and an IN filter, a table of ids gives its distinct folder numbers (at most ``n``
whole numbers) and a semi join, whose side to broadcast AQE decides by bytes. Within a file, row
groups are skipped by the bloom filter and by statistics.

The folder of a user depends on the id and the folder count alone, so a later write of the
same count puts it in the same place. A folder may hold several files.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segrec import schemas
from segrec.session import stored

BUCKETS = 64


def _bucket(user_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(user_id.cast("bigint")), F.lit(buckets).cast("bigint")).cast("int")


def write_served(docs: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Documents (user_id, cluster, recommendations) as a lookup store; replaces what is there.

    Choose ``buckets`` so that a folder is worth opening (some hundred MB): a folder that gets
    more is written as several files, split by user id. Documents without a user are left out, since no
    lookup can name them."""
    if buckets < 1:
        raise ValueError("buckets must be >= 1")
    placed = docs.select("user_id", "cluster", "recommendations").filter(F.col("user_id").isNotNull()).withColumns(
        {"buckets": F.lit(buckets), "bucket": _bucket(F.col("user_id"), buckets)})
    (placed.repartitionByRange("bucket", "user_id").sortWithinPartitions("bucket", "user_id").write.mode("overwrite")
     .option("parquet.bloom.filter.enabled#user_id", "true").option("parquet.bloom.filter.adaptive.enabled#user_id", "true")
     .partitionBy("buckets", "bucket").parquet(path))


class ServedDocuments:
    """A lookup store that ``write_served`` wrote."""

    def __init__(self, spark: SparkSession, path: str):
        placed = T.StructType([*schemas.DOCUMENTS.fields, T.StructField("buckets", T.IntegerType()), T.StructField("bucket", T.IntegerType())])
        self._stored = spark.read.schema(placed).parquet(path)
        first = self._stored.select("buckets").first()  # a folder name: no column is read
        self.buckets = first["buckets"] if first else 1

    def documents(self) -> DataFrame:
        return self._stored.drop("buckets", "bucket")

    def _asked(self, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The distinct ids with their folders, written once, and the documents of those folders."""
        asked = ids.select(F.col(ids.columns[0]).cast("bigint").alias("user_id")).filter("user_id is not null").distinct()
        asked = stored(asked.withColumn("bucket", _bucket(F.col("user_id"), self.buckets)), "asked-ids")
        hit = [r["bucket"] for r in asked.select("bucket").distinct().collect()]  # at most self.buckets numbers
        return asked, self._stored.filter(F.col("bucket").isin(hit))

    def lookup(self, ids: Iterable[int] | DataFrame) -> DataFrame:
        """The documents of the users named, by a list or by the first column of a table."""
        if isinstance(ids, DataFrame):
            asked, docs = self._asked(ids)
            return docs.join(asked, ["bucket", "user_id"], "left_semi").select(*schemas.DOCUMENTS.fieldNames())
        ids = [int(i) for i in ids]
        folders = F.col("bucket").isin([_bucket(F.lit(i), self.buckets) for i in ids])  # folded to literals by the optimiser
        return self._stored.filter(folders & F.col("user_id").isin(ids)).select(*schemas.DOCUMENTS.fieldNames())

    def missing(self, ids: DataFrame) -> DataFrame:
        """The distinct ids of a table without a document."""
        asked, docs = self._asked(ids)
        return asked.join(docs.select("bucket", "user_id"), ["bucket", "user_id"], "left_anti").select("user_id")


__all__ = ["BUCKETS", "ServedDocuments", "write_served"]
