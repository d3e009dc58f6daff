"""Ratings and items views over the Parquet test tables (TPC-H-like star schema).

- ratings: one row per order line: user = ordering customer, item = part, rating in 1..5
  derived from the quantity, timestamp = ship date in epoch seconds.
- items: one row per part: title = part name, genres = part type plus the name's words.

Only the needed columns are selected, so the Parquet scans read just those columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segrec.functions.expressions import epoch_seconds_ntz


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity",
                                                    "l_shipdate")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.select(
        F.col("o_custkey").cast("bigint").alias("userId"),
        F.col("l_partkey").cast("bigint").alias("movieId"),
        (F.col("l_quantity").cast("bigint") % 5 + 1).cast("double").alias("rating"),
        epoch_seconds_ntz("l_shipdate").alias("timestamp"),
    )


def items_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return part.select(
        F.col("p_partkey").cast("bigint").alias("movieId"),
        F.col("p_name").alias("title"),
        F.concat(F.col("p_type"), F.lit("|"), F.regexp_replace("p_name", " ", "|")).alias("genres"),
    )


# Vocabulary used with the items view: the part type words and the part nouns survive the
# membership filter, adjectives do not.
TABLE_GENRES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD",
                "bolt", "gear", "ring", "widget")
