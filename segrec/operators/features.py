"""Per-user features and their standardisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURE_COLUMNS = ("movies_rated", "avg_rating")

def user_features(ratings: DataFrame) -> DataFrame:
    """(userId, movies_rated, avg_rating). ``movies_rated`` counts rating rows, so a user who
    rated one item twice counts it twice. Partial aggregation runs before the shuffle, so a
    user holding a large share of all rows costs one small row per map task."""
    return ratings.groupBy("userId").agg(
        F.count("movieId").alias("movies_rated"),
        F.avg("rating").alias("avg_rating"),
    )


def clusterable(features: DataFrame) -> DataFrame:
    """Users that can be clustered: those with at least one rating value. A user whose ratings
    are all NULL has no mean, and a NULL cannot enter a feature vector."""
    return features.filter(F.col("avg_rating").isNotNull())


def assemble(df: DataFrame, cols: Sequence[str] = FEATURE_COLUMNS, out: str = "features_raw") -> DataFrame:
    """Dense vector of ``cols`` (raises on NULL, like VectorAssembler)."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)


def scale_features(df: DataFrame, cols: Sequence[str] = FEATURE_COLUMNS,
                   raw: str = "features_raw", out: str = "features") -> DataFrame:
    """Assemble ``cols`` and standardise to mean 0 / sample std 1 (a constant column gives 0).

    The fit is one distributed tree aggregate over the rows (mean and variance)."""
    assembled = assemble(df, cols, raw)
    model = StandardScaler(inputCol=raw, outputCol=out, withMean=True, withStd=True).fit(assembled)
    return model.transform(assembled)


def unpack_vector(df: DataFrame, vector_col: str, names: Sequence[str]) -> DataFrame:
    """Vector column -> one double column per name."""
    arr = vector_to_array(F.col(vector_col))
    return df.select("*", *[arr[i].alias(n) for i, n in enumerate(names)]).drop(vector_col)
