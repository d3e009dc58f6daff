"""Recommendation sources: flat rows (JSON Lines, as Spark writes them) and nested served
documents. All are read with a declared schema, so there is no inference pass."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segrec import schemas
from segrec.sources.json_array import read_json_array


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Raise ``ValueError`` naming the missing columns; return ``df`` unchanged otherwise."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns {missing}; available: {sorted(df.columns)}")
    return df


def read_recommendations(spark: SparkSession, path: str, schema=None, fmt: str = "json", check: bool = True) -> DataFrame:
    """Flat recommendations written by the sinks.

    A file without one of the required columns would read as NULLs under a declared schema, so
    they are checked first: against the file's own schema for Parquet; for JSON against the fields
    that occur in any of its lines (lines omit fields that are NULL), one aggregate over all of them. Rows
    that may lack a field throughout, or need no check, are read with ``check=False``. With ``schema=False`` the
    JSON schema is inferred (one extra pass)."""
    required = schemas.REQUIRED_RECOMMENDATION_COLUMNS
    if schema is False:
        return require_columns(getattr(spark.read, fmt)(path), required)
    if check and fmt == "parquet":
        require_columns(spark.read.parquet(path), required)
    elif check:
        # one row: which of the required fields any line has, and how many lines there are
        named = F.json_object_keys("value")
        found = spark.read.text(path).agg(
            F.count(F.lit(1)).alias("lines"), *(F.max(F.array_contains(named, c)).alias(c) for c in required)).first()
        missing = sorted(c for c in required if not found[c])
        if found["lines"] and missing:
            raise ValueError(f"missing columns {missing} in all {found['lines']} lines of {path}")
    return getattr(spark.read.schema(schema or schemas.RECOMMENDATIONS), fmt)(path)


def dedupe_documents(docs: DataFrame) -> DataFrame:
    """One document per user. Of several the longest list wins, then the greatest cluster and
    list: files of a distributed write have no order in which a last one could win. Filters on
    user_id still reach the scan through the grouping."""
    best = F.max(F.struct(F.size("recommendations").alias("n"), "cluster", "recommendations")).alias("best")
    return docs.groupBy("user_id").agg(best).select("user_id", "best.cluster", "best.recommendations")


def read_documents(spark: SparkSession, path: str, multiline: bool = False, fmt: str = "json",
                   unique: bool = False) -> DataFrame:
    """Served documents: ``user_id, cluster, recommendations[{movie_id, movie_title, score}]``,
    one per user (``unique=True``: the files are known to hold one per user, as the sink
    writes them, and need no grouping). ``multiline=True`` reads files of one JSON array each, in
    byte ranges (``json_array``)."""
    if multiline and fmt == "json":
        docs = read_json_array(spark, path, schemas.DOCUMENTS)
    else:
        docs = getattr(spark.read.schema(schemas.DOCUMENTS), fmt)(path)
    return docs if unique else dedupe_documents(docs)
