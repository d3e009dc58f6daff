"""Dataset profile from stored sketches: each load is counted once, later loads are merged.

A profile keeps one row per load: its rating rows and HyperLogLog sketches of its users and
items (``hll_sketch_agg``, a few KB whatever the load). The profile of everything loaded so far is
the union of those rows (``hll_union_agg``); no rating is read again, and a load that is
written once more takes its own row's place.

With ``precision`` p the relative standard error of a distinct count is 1.04 / sqrt(2 ** p):
1.6 % for the default 12, which ``error_bound`` turns into a bound by a number of deviations.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PRECISION = 12


def error_bound(precision: int = PRECISION, deviations: float = 4.0) -> float:
    """Relative error of a distinct count that is passed with the chance of so many deviations
    (4: about one in 16,000)."""
    return deviations * 1.04 / math.sqrt(1 << precision)


def sketch_loads(ratings: DataFrame, load: Column | str, precision: int = PRECISION) -> DataFrame:
    """(load, ratings_rows, users, items): a row per load with its sketches. Sketches are built in
    the map tasks; a hot load sends one per task. NULL ids are not counted; rows of a NULL load are
    the load ``none``."""
    if not 4 <= precision <= 21:
        raise ValueError("precision must be between 4 and 21")
    load = F.col(load) if isinstance(load, str) else load
    return ratings.groupBy(F.coalesce(load.cast("string"), F.lit("none")).alias("load")).agg(
        F.count(F.lit(1)).alias("ratings_rows"),
        F.hll_sketch_agg("userId", precision).alias("users"),
        F.hll_sketch_agg("movieId", precision).alias("items"))


def store_sketches(sketches: DataFrame, path: str) -> None:
    """Add loads to a stored profile; a load that is there already is replaced."""
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load").parquet(path)


def stored_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("ratings_rows bigint, users binary, items binary, load string").parquet(path)


def sketch_profile(sketches: DataFrame) -> DataFrame:
    """One row: loads, ratings_rows (exact), distinct_users and distinct_items (estimates)."""
    return sketches.agg(
        F.count(F.lit(1)).alias("loads"), F.coalesce(F.sum("ratings_rows"), F.lit(0)).alias("ratings_rows"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("users")), F.lit(0)).alias("distinct_users"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("items")), F.lit(0)).alias("distinct_items"))


__all__ = ["PRECISION", "error_bound", "sketch_loads", "sketch_profile", "store_sketches", "stored_sketches"]
