"""The served-recommendations table: one nested document per user, and the queries a lookup
service or a dashboard runs on it (point lookup, paging, summary, preview), as plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segrec.functions.expressions import MORE_SUFFIX, shorten
from segrec.operators.ranking import rank_within_groups


def pack_documents(recs: DataFrame) -> DataFrame:
    """Flat rows -> (user_id, cluster, recommendations array<struct<movie_id, movie_title,
    score>>) ordered by rank. Rows of several runs (a ``k`` column, as the sinks' folders read
    back have) give one document per user and run, with ``k`` kept. A list holds at most top-N
    entries, so the per-user collection is bounded."""
    entry = F.struct(F.col("rank"),
                     F.col("movieId").cast("bigint").alias("movie_id"),
                     F.col("title").alias("movie_title"),
                     F.col("recommendation_score").cast("double").alias("score"))
    run = ["k"] if "k" in recs.columns else []
    packed = recs.groupBy("userId", "cluster", *run).agg(F.sort_array(F.collect_list(entry)).alias("_l"))
    items = F.transform("_l", lambda e: F.struct(e["movie_id"].alias("movie_id"),
                                                 e["movie_title"].alias("movie_title"),
                                                 e["score"].alias("score")))
    return packed.select(F.col("userId").cast("bigint").alias("user_id"),
                         F.col("cluster").cast("bigint").alias("cluster"),
                         items.alias("recommendations"), *run)


def flatten_documents(docs: DataFrame) -> DataFrame:
    """Inverse of ``pack_documents``: (user_id, cluster, position 1.., movie_id, movie_title, score)."""
    exploded = docs.select("user_id", "cluster", F.posexplode("recommendations").alias("pos", "r"))
    return exploded.select("user_id", "cluster",
                           (F.col("pos") + 1).cast("bigint").alias("position"),
                           "r.movie_id", "r.movie_title", "r.score")


def _ids_frame(docs: DataFrame, ids) -> DataFrame:
    if isinstance(ids, DataFrame):
        return ids.select(F.col(ids.columns[0]).cast("bigint").alias("user_id"))
    return docs.sparkSession.createDataFrame([(int(i),) for i in ids], "user_id bigint")


def lookup(docs: DataFrame, ids) -> DataFrame:
    """Documents of the given users. A Python list becomes an IN filter that reaches the scan
    (Parquet row groups are skipped by statistics); a DataFrame of ids is a left-semi join that
    AQE broadcasts when the id list is small."""
    if isinstance(ids, DataFrame):
        return docs.join(_ids_frame(docs, ids), "user_id", "left_semi")
    return docs.filter(F.col("user_id").isin([int(i) for i in ids]))


def missing(docs: DataFrame, ids) -> DataFrame:
    """Requested user ids without a document (the "not found" answers), distinct."""
    return _ids_frame(docs, ids).distinct().join(docs.select("user_id"), "user_id", "left_anti")


def page_ids(docs: DataFrame, limit: int = 100, offset: int = 0, topk_rows: int = 100_000) -> DataFrame:
    """(user_id, position) of documents ``offset + 1 .. offset + limit`` in user_id order.

    Only ids are ordered, never the nested documents. A shallow page is a top-k of at most
    ``topk_rows`` ids per task; a deep one numbers all ids with the distributed positional rank
    (range shuffle, no task holds them all). Rows and order are the same either way."""
    if limit < 0 or offset < 0:
        raise ValueError("limit and offset must be >= 0")
    ids = docs.select("user_id")
    if offset + limit <= topk_rows:
        ids = ids.orderBy("user_id").limit(offset + limit)
        nth = F.row_number().over(Window.orderBy("user_id")).cast("bigint")  # at most topk_rows ids
        numbered = ids.withColumn("position", nth)
    else:
        numbered = rank_within_groups(ids.withColumn("_all", F.lit(0)), ["_all"],
                                      [F.col("user_id").asc()], "position")
    return numbered.filter((F.col("position") > offset) & (F.col("position") <= offset + limit)).select("user_id", "position")


def page(docs: DataFrame, limit: int = 100, offset: int = 0, topk_rows: int = 100_000) -> DataFrame:
    """The documents of one page with their ``position``, in that order."""
    return docs.join(page_ids(docs, limit, offset, topk_rows), "user_id").orderBy("position")


def page_envelope(docs: DataFrame, limit: int = 100, offset: int = 0, topk_rows: int = 100_000) -> DataFrame:
    """One row: total, limit, offset and the page's documents in order (at most ``limit``)."""
    entry = F.struct("position", "user_id", "cluster", "recommendations")
    users = page(docs, limit, offset, topk_rows).agg(F.sort_array(F.collect_list(entry)).alias("_u"))
    user = lambda e: F.struct(e["user_id"].alias("user_id"), e["cluster"].alias("cluster"),
                              e["recommendations"].alias("recommendations"))
    total = docs.select(F.count(F.lit(1))).scalar()
    return users.select(total.alias("total"), F.lit(limit).cast("bigint").alias("limit"),
                        F.lit(offset).cast("bigint").alias("offset"), F.transform("_u", user).alias("users"))


def document_stats(docs: DataFrame) -> DataFrame:
    """One row: users, total recommendations, mean per user (1 decimal), min and max cluster."""
    n = F.size("recommendations")
    stats = docs.agg(
        F.count(F.lit(1)).alias("users"),
        F.coalesce(F.sum(F.when(n > 0, n).otherwise(0)), F.lit(0)).cast("bigint").alias("total_recommendations"),
        F.min("cluster").alias("min_cluster"),
        F.max("cluster").alias("max_cluster"),
    )
    return stats.withColumn("avg_per_user",
                            F.round(F.col("total_recommendations") / F.col("users"), 1))


def preview_documents(docs: DataFrame, n: int = 3, width: int = 30) -> DataFrame:
    """(user_id, cluster, n_recommendations, preview): the first ``n`` titles shortened to
    ``width`` characters, plus a ``+k más`` entry for the rest, joined by `` | ``."""
    recs = F.col("recommendations")
    size = F.size(recs)
    shown = F.transform(F.slice(recs, 1, n), lambda r: shorten(F.coalesce(r["movie_title"], F.lit("")), width))
    more = F.when(size > n, F.array(F.concat(F.lit("+"), (size - n).cast("string"), F.lit(MORE_SUFFIX)))) \
        .otherwise(F.array().cast("array<string>"))
    return docs.select("user_id", "cluster", size.cast("bigint").alias("n_recommendations"),
                       F.array_join(F.concat(shown, more), " | ").alias("preview"))


def count_documents(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count(F.lit(1)).alias("total_users"))


__all__ = ["pack_documents", "flatten_documents", "lookup", "missing", "page", "page_envelope", "page_ids", "document_stats",
           "preview_documents", "count_documents"]
