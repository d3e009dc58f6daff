"""Delimited text sources (``u::m::r::ts`` ratings, ``m::title::genres`` items).

Parsing stays in Spark expressions: ``split`` + ``get`` (NULL when a field is missing) +
``try_cast`` (NULL when a field does not parse), so ANSI mode never aborts a whole job on one
bad line. Any Hadoop file system URI works as ``path`` (local, HDFS, object stores).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MODES = ("permissive", "dropmalformed", "failfast")
DELIMITER = "::"


def _lines(spark: SparkSession, path: str, encoding: str) -> tuple[DataFrame, Column]:
    raw = spark.read.text(path)
    if encoding.upper().replace("_", "-") in ("UTF-8", "UTF8"):
        return raw, F.col("value")
    # The text source keeps the raw bytes; re-decode them with the file's charset.
    return raw, F.decode(F.col("value").cast("binary"), encoding)


def _fields(line: Column, n: int, delimiter: str) -> tuple[Column, list[Column]]:
    parts = F.split(line, _regex(delimiter))
    return parts, [F.get(parts, i) for i in range(n)]


def _regex(delimiter: str) -> str:
    special = set(".^$*+?{}[]\\|()")
    return "".join("\\" + ch if ch in special else ch for ch in delimiter)


def _apply_mode(df: DataFrame, malformed: Column, mode: str, what: str) -> DataFrame:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "permissive":
        return df
    df = df.withColumn("_malformed", malformed)
    if mode == "dropmalformed":
        return df.filter(~F.col("_malformed")).drop("_malformed")
    check = F.when(F.col("_malformed"), F.raise_error(F.concat(F.lit(f"malformed {what} line: "),
                                                               F.col("_line"))))
    return df.filter(check.isNull()).drop("_malformed")


def read_ratings(spark: SparkSession, path: str, mode: str = "permissive",
                 encoding: str = "UTF-8", delimiter: str = DELIMITER) -> DataFrame:
    """Ratings lines ``userId::movieId::rating::timestamp`` -> (userId, movieId, rating, timestamp).

    ``permissive`` keeps every line (unparsable fields are NULL), ``dropmalformed`` drops lines
    with a missing or unparsable field, ``failfast`` raises on the first such line.
    """
    raw, line = _lines(spark, path, encoding)
    parts, (u, m, r, ts) = _fields(line, 4, delimiter)
    typed = raw.select(
        line.alias("_line"),
        F.size(parts).alias("_n"),
        u.try_cast("bigint").alias("userId"),
        m.try_cast("bigint").alias("movieId"),
        r.try_cast("double").alias("rating"),
        ts.try_cast("bigint").alias("timestamp"),
    )
    malformed = ((F.col("_n") != 4) | F.col("userId").isNull() | F.col("movieId").isNull()
                 | F.col("rating").isNull() | F.col("timestamp").isNull())
    out = _apply_mode(typed, malformed, mode, "ratings")
    return out.select("userId", "movieId", "rating", "timestamp")


def read_items(spark: SparkSession, path: str, mode: str = "permissive",
               encoding: str = "UTF-8", delimiter: str = DELIMITER) -> DataFrame:
    """Item lines ``movieId::title::genres`` -> (movieId, title, genres).

    A title holding the delimiter shifts the fields (its second half becomes ``genres``),
    as a plain split does.
    """
    raw, line = _lines(spark, path, encoding)
    parts, (m, title, genres) = _fields(line, 3, delimiter)
    typed = raw.select(
        line.alias("_line"),
        F.size(parts).alias("_n"),
        m.try_cast("bigint").alias("movieId"),
        title.alias("title"),
        genres.alias("genres"),
    )
    malformed = (F.col("_n") < 3) | F.col("movieId").isNull()
    out = _apply_mode(typed, malformed, mode, "items")
    return out.select("movieId", "title", "genres")


def valid_ratings(ratings: DataFrame) -> DataFrame:
    """Rows usable downstream: a NULL user or item can never be matched or excluded, and a
    NULL rating would make a feature vector NULL."""
    return ratings.filter(F.col("userId").isNotNull() & F.col("movieId").isNotNull()
                          & F.col("rating").isNotNull())


def usable_ratings(ratings: DataFrame) -> DataFrame:
    """Rows that name a user and an item. A row without a rating value stays: its item counts
    as seen, it only adds nothing to means and relevance."""
    return ratings.filter(F.col("userId").isNotNull() & F.col("movieId").isNotNull())


def quarantine_ratings(ratings: DataFrame) -> DataFrame:
    """The other rows, with the reason: a NULL user or item can never be matched or excluded."""
    reason = F.when(F.col("userId").isNull(), "no user").when(F.col("movieId").isNull(), "no item")
    return ratings.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def dedupe_items(items: DataFrame) -> DataFrame:
    """One row per movieId, so a duplicated catalogue line cannot duplicate a recommendation:
    the smallest (title, genres), any title before none and any genres before none."""
    first = F.min(F.struct(F.col("title").isNull().alias("untitled"), "title",
                           F.col("genres").isNull().alias("bare"), "genres")).alias("_first")
    return items.groupBy("movieId").agg(first).select("movieId", "_first.title", "_first.genres")


def render_ratings_lines(ratings: DataFrame, delimiter: str = DELIMITER) -> DataFrame:
    """The inverse of ``read_ratings``: one text line per rating, ready for ``write.text``."""
    return ratings.select(F.concat_ws(delimiter, F.col("userId").cast("string"),
                                      F.col("movieId").cast("string"),
                                      F.col("rating").cast("string"),
                                      F.col("timestamp").cast("string")).alias("value"))


def render_items_lines(items: DataFrame, delimiter: str = DELIMITER) -> DataFrame:
    """The inverse of ``read_items``: ``movieId::title::genres`` lines."""
    return items.select(F.concat_ws(delimiter, F.col("movieId").cast("string"), F.col("title"),
                                    F.col("genres")).alias("value"))
