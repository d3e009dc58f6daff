"""Declared schemas of every table the package reads or writes."""

from pyspark.sql import types as T

# The columns of the flat recommendation rows and of the served documents.
RECOMMENDATIONS = T.StructType([
    T.StructField("userId", T.LongType()),
    T.StructField("cluster", T.LongType()),
    T.StructField("movieId", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
    T.StructField("cluster_avg_movie_rating", T.DoubleType()),
    T.StructField("cluster_rating_count", T.LongType()),
    T.StructField("recommendation_score", T.DoubleType()),
    T.StructField("rank", T.LongType()),
])

# Columns a flat recommendation file must carry before it can be packed.
REQUIRED_RECOMMENDATION_COLUMNS = ("userId", "cluster", "movieId", "title", "recommendation_score")

RECOMMENDATION_ITEM = T.StructType([
    T.StructField("movie_id", T.LongType()),
    T.StructField("movie_title", T.StringType()),
    T.StructField("score", T.DoubleType()),
])

DOCUMENTS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("cluster", T.LongType()),
    T.StructField("recommendations", T.ArrayType(RECOMMENDATION_ITEM)),
])
