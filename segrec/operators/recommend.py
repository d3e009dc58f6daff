"""Per-user top-N unseen items from the user's cluster ranking, exact and without a
user x item fan-out.

Inside one cluster every user sees the same item order (score desc, count desc, movieId asc),
so a user's list is "the first N items of the cluster order that the user has not rated".
With ``s_1 < s_2 < ...`` the cluster positions of the user's rated items, the j-th unseen
position is

    r_j = j + #{ i : s_i - i < j }        (s_i - i = unseen items ranked above s_i)

so the list needs only (a) the cluster position of every rated item, an equi-join of the
distinct rated pairs with the ranked item table, and (b) per user a histogram of
``gap = s_i - i`` restricted to gaps < N (at most N entries), computed per block of
positions so that no task holds a whole user history. The j-th item is then an
equi-join on (cluster, position r_j). Work is O(rated pairs + users * N); no candidate pair
that ends up discarded is ever built, and no anti join is needed.

Since ``i`` is at most the number of items that the user has rated, a gap below N lies at
``s_i < N + n`` and every ``r_j <= N + n``, with ``n`` the longest history. Only this head of each
cluster order (``head_of``) meets the rated pairs and the users; if it is small it is broadcast and
the pairs are not shuffled again. A history as long as the catalogue leaves the whole order.

Every rated item of a user is in the user's cluster table (the table is built from the train
rows of the cluster's members), which is what makes the counting exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segrec.operators.ranking import rank_within_groups
from segrec.operators.scoring import score_order

# Rows of the head of the cluster orders up to which it is broadcast (twice a run, once with titles).
HEAD_ROWS = 100_000

# The columns of the flat recommendation rows.
RECOMMENDATION_COLUMNS = ("userId", "cluster", "movieId", "title", "genres",
                          "cluster_avg_movie_rating", "cluster_rating_count",
                          "recommendation_score", "rank")


def seen_items(train: DataFrame) -> DataFrame:
    """Distinct (userId, movieId) pairs of the train split."""
    return train.select("userId", "movieId").distinct()


def rank_items(scores: DataFrame) -> DataFrame:
    """Scores plus ``cluster_rank``: the item's position in its cluster's order (distributed:
    no cluster is sorted in one task)."""
    return rank_within_groups(scores, ["cluster"], score_order(), "cluster_rank")


def longest_history(rated: DataFrame) -> int:
    """The most rows that a user has in ``rated``; the same for every clustering of the same users."""
    history = rated.groupBy("userId").agg(F.count(F.lit(1)).alias("n"))
    return history.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n")).first()["n"]


def head_of(ranked: DataFrame, top_n: int, longest: int) -> tuple[DataFrame, int]:
    """The rows of ``ranked`` that any list of ``top_n`` can depend on, and how many they are."""
    head = ranked.filter(F.col("cluster_rank") <= F.lit(top_n + longest))
    return head, head.count()


def attach_items(ranked: DataFrame, items: DataFrame | None) -> DataFrame:
    """Title and genres on the ranked (cluster, item) table, before users are involved: the
    ranked table has one row per (cluster, item), far fewer than users x N, and a popular item
    is one key here instead of a hot key on the recommendation side."""
    if items is None:
        return (ranked.withColumn("title", F.lit(None).cast("string"))
                .withColumn("genres", F.lit(None).cast("string")))
    return ranked.join(items.select("movieId", "title", "genres"), "movieId", "left")


def gap_histogram(rated: DataFrame, ranked: DataFrame, top_n: int, block_size: int = 1024,
                  join_hint: str | None = None) -> DataFrame:
    """Per user: (userId, hist array<struct<gap, n>>) with the gaps below ``top_n``.

    ``rated`` is ``with_clusters`` output (one row per user and item). The join with the ranked
    table, the largest of a run, is made once. No group holds a user's whole history: cluster
    positions are cut into blocks of ``block_size`` and the rated positions are collected per
    (user, block), at most ``block_size`` of them. A per-user running count over the non-empty
    blocks (at most catalogue / block_size rows per user) gives the rated items before each
    block; only blocks with fewer than ``top_n`` unseen positions before them can hold a gap
    below ``top_n``, and a position's place in its block gives the rest of its gap.
    """
    positions = ranked.select("cluster", "movieId", "cluster_rank")
    if join_hint:
        positions = positions.hint(join_hint)
    seen_pos = rated.select("userId", "cluster", "movieId").join(positions, ["cluster", "movieId"]).select(
        "userId", "cluster_rank",
        F.floor((F.col("cluster_rank") - 1) / F.lit(block_size)).cast("bigint").alias("block"))
    blocks = seen_pos.groupBy("userId", "block").agg(F.sort_array(F.collect_list("cluster_rank")).alias("_taken"))
    earlier = Window.partitionBy("userId").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (blocks
              .withColumn("_before", F.coalesce(F.sum(F.size("_taken")).over(earlier), F.lit(0)))
              # unseen positions before the block = block * size - rated items before it
              .filter(F.col("block") * F.lit(block_size) - F.col("_before") < F.lit(top_n)))
    gaps = (blocks.select("userId", "_before", F.posexplode("_taken").alias("_i", "_rank"))
            .select("userId", (F.col("_rank") - F.col("_before") - F.col("_i") - 1).alias("gap"))
            .filter(F.col("gap") < F.lit(top_n)))
    counts = gaps.groupBy("userId", "gap").agg(F.count(F.lit(1)).alias("n"))
    # At most top_n entries per user.
    return counts.groupBy("userId").agg(F.collect_list(F.struct("gap", "n")).alias("hist"))


def wanted_positions(user_clusters: DataFrame, hist: DataFrame, top_n: int) -> DataFrame:
    """(userId, cluster, rank j, cluster_rank r_j) for j = 1..top_n."""
    empty = F.array().cast("array<struct<gap:bigint,n:bigint>>")
    h = F.coalesce(F.col("hist"), empty)

    def position(j):
        above = F.aggregate(F.filter(h, lambda x: x["gap"] < j), F.lit(0).cast("bigint"),
                            lambda acc, x: acc + x["n"])
        return F.struct(j.cast("bigint").alias("rank"), (j + above).cast("bigint").alias("cluster_rank"))

    positions = F.transform(F.sequence(F.lit(1), F.lit(top_n)), position)
    return (user_clusters.select("userId", "cluster")
            .join(hist, "userId", "left")
            .select("userId", "cluster", F.inline(positions)))


def items_at(wanted: DataFrame, catalog: DataFrame, top_n: int, salts: int = 16,
             join_hint: str | None = None) -> DataFrame:
    """``wanted`` joined with the item at its (cluster, cluster_rank).

    Nearly all users want the first positions of their cluster, so a few keys hold nearly all
    rows. Those positions (the first ``16 * top_n``) are salted: users are spread over
    ``salts`` copies of the head of the catalogue, which has at most clusters * 16 * top_n rows.
    Later positions have one copy."""
    head = F.col("cluster_rank") <= F.lit(16 * top_n)
    left = wanted.withColumn("_salt", F.when(head, F.pmod(F.xxhash64("userId"), F.lit(salts))).otherwise(F.lit(0)).cast("int"))
    right = catalog.withColumn("_salt", F.explode(F.when(head, F.sequence(F.lit(0), F.lit(salts - 1)))
                                                  .otherwise(F.array(F.lit(0)))))
    if join_hint:
        right = right.hint(join_hint)
    return left.join(right, ["cluster", "cluster_rank", "_salt"]).drop("_salt")


def recommend(rated: DataFrame, user_clusters: DataFrame, scores: DataFrame,
              items: DataFrame | None = None, top_n: int = 10, ranked: DataFrame | None = None,
              block_size: int = 1024, salts: int = 16, join_hint: str | None = None, longest: int | None = None) -> DataFrame:
    """Top-``top_n`` unseen items per user, ranked by (score desc, count desc, movieId asc).

    rated: ``with_clusters`` output; user_clusters: (userId, cluster); scores:
    ``cluster_item_scores(rated)``; items: (movieId, title, genres) or None. A user whose
    cluster has fewer unseen items gets fewer rows. ``ranked`` may pass a persisted
    ``rank_items(scores)``. A head of the cluster orders of at most ``HEAD_ROWS`` rows is broadcast; else it
    is left to the bytes at run time. ``join_hint`` ("merge") forces the plan of large tables. ``longest`` may
    pass ``longest_history(rated)``, which a sweep counts once; the head is counted in any case.
    """
    if top_n < 1:
        raise ValueError("top_n must be >= 1")
    if ranked is None:
        ranked = rank_items(scores)
    head, rows = head_of(ranked, top_n, longest_history(rated) if longest is None else longest)
    if join_hint is None and rows <= HEAD_ROWS:
        join_hint, salts = "broadcast", 1
    hist = gap_histogram(rated, head, top_n, block_size=block_size, join_hint=join_hint)
    wanted = wanted_positions(user_clusters, hist, top_n)
    catalog = attach_items(head, items).select(
        "cluster", "cluster_rank", "movieId", "title", "genres",
        "cluster_avg_movie_rating", "cluster_rating_count", "recommendation_score")
    return items_at(wanted, catalog, top_n, salts, join_hint).select(*RECOMMENDATION_COLUMNS)


def candidate_counts(user_clusters: DataFrame, scores: DataFrame, rated: DataFrame) -> DataFrame:
    """(userId, candidates): unseen items of the user's cluster, i.e. cluster items minus the
    user's distinct rated items (all of which are cluster items), without listing pairs. A user
    who rated them all has no candidate and no row, as an anti join would leave it.
    ``rated`` is ``with_clusters`` output (one row per user and item)."""
    cluster_size = scores.groupBy("cluster").agg(F.count(F.lit(1)).alias("_items"))
    seen = rated.groupBy("userId").agg(F.count(F.lit(1)).alias("_seen"))
    # cluster_size has one row per cluster; its measured bytes make the join a broadcast
    return (user_clusters.select("userId", "cluster")
            .join(cluster_size, "cluster")
            .join(seen, "userId", "left")
            .select("userId", (F.col("_items") - F.coalesce(F.col("_seen"), F.lit(0))).alias("candidates"))
            .filter(F.col("candidates") > 0))


def sample_recommendations(recs: DataFrame, n_users: int = 20) -> DataFrame:
    """All recommendations of the ``n_users`` smallest user ids that have any, by (userId, rank).

    Every user with a list has exactly one rank-1 row, so the user list is a top-k
    (``TakeOrderedAndProject``) over those rows: no distinct shuffle, at most ``n_users`` rows
    broadcast."""
    users = recs.filter(F.col("rank") == 1).select("userId").orderBy("userId").limit(n_users)
    return recs.join(F.broadcast(users), "userId", "left_semi").orderBy("userId", "rank")
