"""

Every query reads the whole Parquet tables of ``sf_dir`` through the ratings/items views of
``segrec.sources.tables`` and returns a DataFrame. Building it may run checkpoints and write
tables below ``spark.checkpoint.dir``; the round-trip and pipeline queries also write their
files there. Doubles are rounded to 6 decimals and integers are BIGINT on both sides so the
DuckDB oracles compare value by value. Clusters are injected (``cluster = #{25, 40} below
movies_rated``) in the checked queries; K-Means labels depend on partitioning, so the K-Means
queries return what holds for any labels (counts that SQL can give, and properties that the
oracle derives from those counts).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segrec.functions.expressions import ACTIVITY_LABELS, DESCRIPTION_JOINER, RATING_LABELS
from segrec.operators.clusters import (
    assign_by_thresholds,
    assign_nearest,
    cost_agreement,
    describe_clusters,
    fit_sweep,
    kmeans_invariants,
    training_cost,
)
from segrec.operators.evaluate import global_metrics, relevant_counts
from segrec.operators.features import unpack_vector, user_features
from segrec.operators.layout import UserLayout
from segrec.operators.prepare import explode_genres, hash_split, profile, random_split, rating_distribution, split_profile
from segrec.operators.recommend import (
    candidate_counts,
    longest_history,
    rank_items,
    recommend,
    sample_recommendations,
    seen_items,
)
from segrec.operators.scoring import cluster_genres, cluster_item_scores, cluster_stats, clusters_of, top_genres, with_clusters
from segrec.operators.served import ServedDocuments, write_served
from segrec.operators.serving import (
    count_documents,
    document_stats,
    flatten_documents,
    lookup,
    missing,
    pack_documents,
    page,
    page_envelope,
    preview_documents,
)
from segrec.operators.sketches import error_bound, sketch_loads, sketch_profile, store_sketches, stored_sketches
from segrec.operators.sweep import best_k, metrics_summary, union_metrics
from segrec.config import RunConfig
from segrec.plans.pipeline import run_k, run_pipeline
from segrec.sinks import write_documents, write_outputs
from segrec.sinks.staged import committed
from segrec.plans.workload import SWEEP_THRESHOLDS, TableWorkload
from segrec.session import scratch_path, stored
from segrec.sources.json import read_documents, read_recommendations
from segrec.sources.json_array import write_json_array
from segrec.sources.tables import TABLE_GENRES, table
from segrec.sources.text import (
    dedupe_items,
    quarantine_ratings,
    read_items,
    read_ratings,
    render_items_lines,
    render_ratings_lines,
    usable_ratings,
)

SMOKE_DIR = "/root/testdata/sf0.001"
# Fixed centres (movies_rated, avg_rating) for the SQL-checkable assignment.
FIXED_CENTERS = ((20.0, 3.0), (32.0, 2.8), (32.0, 3.2), (48.0, 3.0))
SWEEP_KS = (3, 5, 8)
# Five clusters and label thresholds between their averages: every label occurs.
LABEL_CLUSTERS = (15, 25, 35, 50)
LABEL_ACTIVITY = (20, 40)
LABEL_RATING = (2.995, 3.005)
# Ids of a lookup by list; the last does not exist.
LOOKUP_IDS = (3, 5, 77, 10**9)


def _r(c, d=6):
    return F.round(F.col(c), d).alias(c)


def _w(spark: SparkSession, sf_dir: str) -> TableWorkload:
    return TableWorkload(spark, sf_dir)


# ---------------------------------------------------------------------------------------
# queries
# ---------------------------------------------------------------------------------------

def q_profile(spark, sf_dir):
    w = _w(spark, sf_dir)
    return profile(w.ratings, w.items)


def q_split_profile(spark, sf_dir):
    w = _w(spark, sf_dir)
    return split_profile(w.train, w.test)


def q_rating_distribution(spark, sf_dir):
    return rating_distribution(_w(spark, sf_dir).ratings)


def q_hash_split_train(spark, sf_dir):
    return _w(spark, sf_dir).train


def q_hash_split_test(spark, sf_dir):
    return _w(spark, sf_dir).test


def q_hash_split_negative(spark, sf_dir):
    # negated ids fall into buckets like any others
    w = _w(spark, sf_dir)
    ratings = w.ratings.withColumn("userId", -F.col("userId")).withColumn("movieId", -F.col("movieId"))
    train, test = hash_split(ratings, 0.8)
    side = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return side.select("userId", "movieId", "rating", "timestamp", "side")


def q_hash_split_fraction(spark, sf_dir):
    train, test = hash_split(_w(spark, sf_dir).ratings, 0.75, buckets=100)
    return split_profile(train, test)


def q_random_split(spark, sf_dir):
    # the rows of both sides, each with whether its side has its share; which side a row is on is the sampler's
    train, test = random_split(_w(spark, sf_dir).ratings, (0.8, 0.2), RunConfig().seed)
    sides = []
    for side, share in ((train, 0.8), (test, 0.2)):
        near = F.abs(side.select(F.count(F.lit(1))).scalar() / train.unionByName(test).select(F.count(F.lit(1))).scalar() - share) < 0.05
        sides.append(side.select("userId", "movieId", "rating", "timestamp", near.alias("share_is_near")))
    return sides[0].unionByName(sides[1])


def q_item_genres(spark, sf_dir):
    return _w(spark, sf_dir).item_genres


def q_item_genres_table(spark, sf_dir):
    # the vocabulary as a table: the words of all part types and the last words of all part names
    part = table(spark, sf_dir, "part")
    words = part.select(F.explode(F.split("p_type", " ")).alias("word")).unionByName(
        part.select(F.substring_index("p_name", " ", -1).alias("word")))
    return explode_genres(_w(spark, sf_dir).items, words)


def q_profile_sketches(spark, sf_dir):
    # loads by year: all but the first are added to a stored profile one by one, one of them twice
    w = _w(spark, sf_dir)
    path = scratch_path(spark, "sketches")
    year = F.year(F.timestamp_seconds("timestamp"))
    loads = sketch_loads(w.ratings, year)
    store_sketches(loads.filter("load < '1995'"), path)
    store_sketches(loads.filter("load >= '1995'"), path)
    store_sketches(loads.filter("load = '1995'"), path)
    merged, exact = sketch_profile(stored_sketches(spark, path)), profile(w.ratings, w.items)
    both = merged.select("loads", F.col("ratings_rows").alias("rows"), F.col("distinct_users").alias("u"), F.col("distinct_items").alias("i")).join(exact)
    within = lambda a, b: F.abs(F.col(a) - F.col(b)) <= error_bound() * F.col(b)
    return both.select("loads", F.col("rows").alias("ratings_rows"), "distinct_users", "distinct_items",
                       within("u", "distinct_users").alias("users_within_bound"), within("i", "distinct_items").alias("items_within_bound"))


def q_user_features(spark, sf_dir):
    return user_features(_w(spark, sf_dir).train).select("userId", "movies_rated", _r("avg_rating"))


def q_scaled_features(spark, sf_dir):
    scaled = _w(spark, sf_dir).scaled
    out = unpack_vector(scaled.drop("features_raw"), "features",
                        ["movies_rated_scaled", "avg_rating_scaled"])
    return out.select("userId", _r("movies_rated_scaled"), _r("avg_rating_scaled"))


def q_assign_nearest(spark, sf_dir):
    feats = _w(spark, sf_dir).features
    return assign_nearest(feats, FIXED_CENTERS, ["movies_rated", "avg_rating"]).select("userId", "cluster")


def q_kmeans_assign(spark, sf_dir):
    # a converged fit: every label is a cluster of the model, every centre the mean of its members
    k = SWEEP_KS[0]
    w = _w(spark, sf_dir)
    model, user_clusters = w.kmeans(k, maxIter=200, tol=0.0)
    centers = spark.createDataFrame([(i, *map(float, c)) for i, c in enumerate(model.clusterCenters())],
                                    "cluster bigint, c0 double, c1 double")
    scaled = unpack_vector(w.scaled.select("userId", "features"), "features", ["f0", "f1"])
    means = (user_clusters.join(scaled, "userId").groupBy("cluster")
             .agg(F.count(F.lit(1)).alias("n"), F.avg("f0").alias("m0"), F.avg("f1").alias("m1")))
    near = (F.abs(F.col("m0") - F.col("c0")) < 1e-6) & (F.abs(F.col("m1") - F.col("c1")) < 1e-6)
    return means.join(centers, "cluster", "left").agg(
        F.sum("n").alias("users"), F.sum(F.when(F.col("cluster").between(0, k - 1), F.col("n"))).alias("users_in_range"),
        F.sum(F.when(near, F.col("n"))).alias("users_at_means"))


def q_kmeans_invariants(spark, sf_dir):
    w = _w(spark, sf_dir)
    model, _ = w.kmeans(SWEEP_KS[-1])
    return kmeans_invariants(model, w.scaled)


def q_kmeans_sweep_metrics(spark, sf_dir):
    # one join of the pairs for all K; per K what holds for any labels
    w = _w(spark, sf_dir)
    models = fit_sweep(w.scaled, SWEEP_KS, w.cfg.seed, parallelism=w.cfg.fit_parallelism)
    users = w.scaled
    for k, model in models.items():
        users = model.transform(users).withColumn(f"cluster_{k}", F.col("prediction").cast("bigint")).drop("prediction")
    columns = tuple(f"cluster_{k}" for k in models)
    users = stored(users.select("userId", "movies_rated", "avg_rating", *columns), "users")
    tagged = with_clusters(w.pairs, users, columns).persist()
    metrics, longest = [], longest_history(tagged)
    for k in SWEEP_KS:
        user_clusters = users.select("userId", F.col(f"cluster_{k}").alias("cluster"), "movies_rated", "avg_rating")
        result = run_k(w.pairs, w.test, user_clusters, k, w.items, None, w.cfg, cost=training_cost(models[k]),
                       relevant=w.relevant, rated=clusters_of(tagged, f"cluster_{k}"), longest=longest)
        metrics.append(result.global_metrics)
    return _checked_metrics(metrics_summary(union_metrics(metrics)), cost_agreement(models, w.scaled))


def _checked_metrics(summary: DataFrame, costs: DataFrame) -> DataFrame:
    """k, evaluated users, whether precision and recall lie in their range, and whether the cost reported
    is that of the assignment and falls with K."""
    inside = F.col("precision_at_k").between(0.0, 1.0) & F.col("recall_at_k").between(0.0, 1.0)
    costs = costs.select("k", F.col("training_cost").alias("cost"), "cost_agrees", "cost_falls")
    return summary.join(costs, "k").select(
        "k", "evaluated_users", F.when(inside, F.col("evaluated_users")).alias("users_with_valid_metrics"),
        (F.col("cost_agrees") & (F.col("cost") == F.col("training_cost"))).alias("cost_agrees"), "cost_falls")


def q_kmeans_costs(spark, sf_dir):
    w = _w(spark, sf_dir)
    models = fit_sweep(w.scaled, SWEEP_KS, w.cfg.seed, parallelism=w.cfg.fit_parallelism)
    return cost_agreement(models, w.scaled).select("k", "users", "cost_agrees", "cost_falls")


def q_cluster_stats(spark, sf_dir):
    stats = cluster_stats(_w(spark, sf_dir).user_clusters)
    return stats.select("cluster", _r("avg_movies_rated"), _r("avg_user_rating"), "num_users")


def q_describe_clusters(spark, sf_dir):
    stats = cluster_stats(_w(spark, sf_dir).user_clusters)
    return describe_clusters(stats).select("cluster", "activity", "rating_profile", "description")


def q_describe_clusters_all_labels(spark, sf_dir):
    # five clusters and thresholds inside the range of their averages, so every label occurs
    stats = cluster_stats(assign_by_thresholds(_w(spark, sf_dir).features, LABEL_CLUSTERS))
    described = describe_clusters(stats, LABEL_ACTIVITY, LABEL_RATING)
    return described.select("cluster", "activity", "rating_profile", "description")


def q_cluster_item_scores(spark, sf_dir):
    w = _w(spark, sf_dir)
    return (w.scores.join(w.items, "movieId", "left")
            .select("cluster", "movieId", _r("cluster_avg_movie_rating"), "cluster_rating_count",
                    _r("recommendation_score"), "title", "genres"))


def q_cluster_item_scores_layout(spark, sf_dir):
    # the pairs stored by user, users of more than 40 pairs apart; the clusters of three runs in one join
    w = _w(spark, sf_dir)
    users = w.features
    for t in SWEEP_THRESHOLDS:
        users = assign_by_thresholds(users, t, out=f"cluster_{len(t) + 1}")
    columns = tuple(f"cluster_{len(t) + 1}" for t in SWEEP_THRESHOLDS)
    with UserLayout.store(w.pairs, buckets=8, hot_rows=40) as layout:
        tagged = layout.with_clusters(stored(users, "users"), columns)
        scores = None
        for c in columns:
            run = cluster_item_scores(clusters_of(tagged, c)).withColumn("k", F.lit(int(c.rsplit("_", 1)[1])).cast("bigint"))
            scores = run if scores is None else scores.unionByName(run)
        out = stored(scores, "layout-scores")
    return out.select("k", "cluster", "movieId", _r("cluster_avg_movie_rating"), "cluster_rating_count", _r("recommendation_score"))


def q_cluster_item_ranks(spark, sf_dir):
    # the distributed ranking (range slices + offsets), whatever the table size
    return rank_items(_w(spark, sf_dir).scores).select("cluster", "movieId", "cluster_rank")


def q_cluster_genres(spark, sf_dir):
    w = _w(spark, sf_dir)
    return cluster_genres(w.rated, w.item_genres)


def q_top_genres(spark, sf_dir):
    w = _w(spark, sf_dir)
    return top_genres(cluster_genres(w.rated, w.item_genres), w.cfg.top_genres)


def q_seen_items(spark, sf_dir):
    return seen_items(_w(spark, sf_dir).train)


def q_seen_items_null_rating(spark, sf_dir):
    # every third rating value missing: the items count as seen all the same
    ratings = _w(spark, sf_dir).ratings
    ratings = ratings.withColumn("rating", F.when(F.col("movieId") % 3 != 0, F.col("rating")))
    train, _ = hash_split(usable_ratings(ratings), 0.8)
    return seen_items(train)


def q_unseen_candidates(spark, sf_dir):
    w = _w(spark, sf_dir)
    return candidate_counts(w.user_clusters, w.scores, w.rated)


def _recs_out(recs: DataFrame) -> DataFrame:
    return recs.select("userId", "cluster", "movieId", "title", "genres",
                       _r("cluster_avg_movie_rating"), "cluster_rating_count",
                       _r("recommendation_score"), "rank")


def q_recommend_topn(spark, sf_dir):
    return _recs_out(_w(spark, sf_dir).recommendations)


def q_recommend_topn_blocked(spark, sf_dir):
    # the same recommendations with histories cut into many blocks of 16 cluster positions
    w = _w(spark, sf_dir)
    return _recs_out(recommend(w.rated, w.user_clusters, w.scores, w.items, w.cfg.top_n, ranked=w.ranked, block_size=16))


def q_recommend_topn_large(spark, sf_dir):
    # the plan of large tables: no side is broadcast, every join shuffles
    w = _w(spark, sf_dir)
    return _recs_out(recommend(w.rated, w.user_clusters, w.scores, w.items, w.cfg.top_n, ranked=w.ranked,
                               block_size=16, join_hint="merge"))


def q_sample_recommendations(spark, sf_dir):
    w = _w(spark, sf_dir)
    return _recs_out(sample_recommendations(w.recommendations, w.cfg.sample_users))


def q_relevant_counts(spark, sf_dir):
    return relevant_counts(_w(spark, sf_dir).relevant)


def q_per_user_metrics(spark, sf_dir):
    return _w(spark, sf_dir).per_user.select("userId", "relevant_count", "hits",
                                             _r("precision_at_k"), _r("recall_at_k"))


def q_global_metrics(spark, sf_dir):
    g = global_metrics(_w(spark, sf_dir).per_user)
    return g.select(_r("precision_at_k"), _r("recall_at_k"), "evaluated_users")


def _sweep_metrics(spark, sf_dir):
    metrics = []
    for w in _w(spark, sf_dir).sweep(SWEEP_THRESHOLDS):
        metrics.append(global_metrics(w.per_user).withColumn("k", F.lit(w.k).cast("bigint")))
    return union_metrics(metrics)


def q_metrics_summary(spark, sf_dir):
    return metrics_summary(_sweep_metrics(spark, sf_dir)).select(
        "k", _r("precision_at_k"), _r("recall_at_k"), "evaluated_users", "ordinal")


def q_best_k(spark, sf_dir):
    return best_k(_sweep_metrics(spark, sf_dir)).select(
        "k", _r("precision_at_k"), _r("recall_at_k"), "evaluated_users")


def q_documents_flat(spark, sf_dir):
    flat = flatten_documents(_w(spark, sf_dir).documents)
    return flat.select("user_id", "cluster", "position", "movie_id", "movie_title", _r("score"))


def q_document_stats(spark, sf_dir):
    return document_stats(_w(spark, sf_dir).documents)


def q_preview_documents(spark, sf_dir):
    return preview_documents(_w(spark, sf_dir).documents)


def _asked_ids(spark, sf_dir):
    # three times the customer number: a third of the ids exist, the others do not
    return table(spark, sf_dir, "customer").select((F.col("c_custkey") * 3).alias("user_id"))


def _flat(docs: DataFrame) -> DataFrame:
    return flatten_documents(docs).select("user_id", "cluster", "position", "movie_id", _r("score"))


def _served(spark, sf_dir) -> ServedDocuments:
    path = scratch_path(spark, "served")
    write_served(_w(spark, sf_dir).documents, path)
    return ServedDocuments(spark, path)


def q_lookup_users(spark, sf_dir):
    # a table of ids against the lookup store
    return _flat(_served(spark, sf_dir).lookup(_asked_ids(spark, sf_dir)))


def q_lookup_users_pruned(spark, sf_dir):
    # a table of few ids: most folders of the store are not read
    asked = table(spark, sf_dir, "nation").select((F.col("n_nationkey") * 5 + 1).alias("id"))
    return _flat(_served(spark, sf_dir).lookup(asked))


def q_lookup_list(spark, sf_dir):
    # a Python list of ids against stored documents: the filter reaches the Parquet scan
    path = scratch_path(spark, "documents")
    write_documents(_w(spark, sf_dir).documents, path, "parquet")
    return _flat(lookup(read_documents(spark, path, fmt="parquet", unique=True), LOOKUP_IDS))


def q_missing_users(spark, sf_dir):
    return missing(_w(spark, sf_dir).documents, _asked_ids(spark, sf_dir))


def _paged(docs: DataFrame) -> DataFrame:
    entry = docs.select("user_id", F.col("position").alias("place"), "cluster", F.posexplode("recommendations").alias("i", "r"))
    return entry.select("user_id", "place", "cluster", (F.col("i") + 1).cast("bigint").alias("position"),
                        F.col("r.movie_id").alias("movie_id"), F.round("r.score", 6).alias("score"))


def q_page_users(spark, sf_dir):
    return _paged(page(_w(spark, sf_dir).documents, limit=100, offset=100))


def q_page_users_deep(spark, sf_dir):
    # the same page through the distributed positional path used for deep offsets
    return _paged(page(_w(spark, sf_dir).documents, limit=100, offset=100, topk_rows=0))


def q_page_envelope(spark, sf_dir):
    out = page_envelope(_w(spark, sf_dir).documents, limit=50, offset=25)
    return out.select("total", "limit", "offset", F.posexplode("users").alias("i", "u")).select(
        "total", "limit", "offset", F.col("i").cast("bigint").alias("place"), "u.user_id",
        F.size("u.recommendations").cast("bigint").alias("n_recommendations"))


def q_duplicate_documents(spark, sf_dir):
    # every document twice, once cut to its first half: one, the longer, is served
    docs = _w(spark, sf_dir).documents
    half = docs.withColumn("recommendations", F.expr("slice(recommendations, 1, 5)"))
    path = scratch_path(spark, "documents")
    docs.unionByName(half).write.json(path)
    return _flat(read_documents(spark, path))


def q_roundtrip_json(spark, sf_dir):
    path = scratch_path(spark, "roundtrip-json")
    write_outputs({"recommendations_topn": _w(spark, sf_dir).recommendations}, path)
    return _recs_out(read_recommendations(spark, f"{path}/recommendations_topn"))


def q_run_k_outputs(spark, sf_dir):
    # a run with injected clusters through the real sinks, packed again from what they wrote
    w = _w(spark, sf_dir)
    result = run_k(w.pairs, w.test, w.user_clusters, w.k, w.items, w.item_genres, w.cfg, cost=0.0, relevant=w.relevant)
    path = scratch_path(spark, "run")
    write_outputs(result.tables(), path, "parquet")
    recs = spark.read.parquet(f"{path}/recommendations_topn")
    docs = pack_documents(recs)
    return docs.select("k", "user_id", "cluster", F.posexplode("recommendations").alias("i", "r")).select(
        F.col("k").cast("bigint").alias("k"), "user_id", "cluster", (F.col("i") + 1).cast("bigint").alias("position"),
        "r.movie_id", F.round("r.score", 6).alias("score"))


def q_parse_items_lines(spark, sf_dir):
    items = _w(spark, sf_dir).items
    path = scratch_path(spark, "items-lines")
    lines = render_items_lines(items)
    short = lines.select(F.substring_index("value", "::", 2).alias("value"))  # no genres: malformed
    lines.unionByName(short).write.mode("overwrite").text(path)
    return read_items(spark, path, mode="dropmalformed")


def q_parse_items_latin1(spark, sf_dir):
    # titles with letters beyond ASCII, written as single bytes and read back with that encoding
    items = _w(spark, sf_dir).items.withColumn("title", F.concat("title", F.lit(" é ñ ü ß"), F.col("movieId").cast("string")))
    path = scratch_path(spark, "items-latin1")
    # the bytes of a line in ISO-8859-1, written as they are
    render_items_lines(items).select(F.encode("value", "ISO-8859-1").cast("string").alias("value")).write.text(path)
    return read_items(spark, path, encoding="ISO-8859-1")


def q_dedupe_items(spark, sf_dir):
    items = _w(spark, sf_dir).items
    copies = items.withColumn("title", F.lit(None).cast("string")).unionByName(items.withColumn("title", F.concat("title", F.lit("~"))))
    return dedupe_items(items.unionByName(copies))


def q_roundtrip_documents(spark, sf_dir):
    docs = _w(spark, sf_dir).documents
    path = scratch_path(spark, "documents")
    write_documents(docs, path)
    flat = flatten_documents(read_documents(spark, path, unique=True))
    return flat.select("user_id", "cluster", "position", "movie_id", "movie_title", _r("score"))


def q_roundtrip_json_array(spark, sf_dir):
    # files of one array each, two and one more per 200,000 users, read in ranges of 64 KB; written while that setting holds
    path, setting = scratch_path(spark, "documents-array"), "spark.sql.files.maxPartitionBytes"
    w = _w(spark, sf_dir)
    write_json_array(w.documents.repartition(2 + w.features.count() // 200_000, "user_id"), path)
    usual = spark.conf.get(setting)
    spark.conf.set(setting, 64 << 10)
    try:
        docs = stored(read_documents(spark, path, multiline=True, unique=True), "documents-read")
    finally:
        spark.conf.set(setting, usual)
    return flatten_documents(docs).select("user_id", "cluster", "position", "movie_id", "movie_title", _r("score"))


def q_count_documents(spark, sf_dir):
    return count_documents(_w(spark, sf_dir).documents)


def q_pipeline_summary(spark, sf_dir):
    w = _w(spark, sf_dir)
    cfg = RunConfig(k_values=SWEEP_KS, genre_vocabulary=TABLE_GENRES)
    result = run_pipeline(w.ratings, w.items, cfg, out=scratch_path(spark, "pipeline"), checkpoint=True)
    return _checked_metrics(result.summary, result.costs)


def q_pipeline_injected(spark, sf_dir):
    # known clusters through the whole pipeline, in two attempts: the first stages one K, the second
    # takes it over and publishes; what is returned was read from the published files
    w = _w(spark, sf_dir)
    cfg = RunConfig(genre_vocabulary=TABLE_GENRES)
    out = scratch_path(spark, "injected")
    cuts = {len(t) + 1: (lambda features, t=t: assign_by_thresholds(features, t)) for t in SWEEP_THRESHOLDS}
    first = {k: cut for k, cut in list(cuts.items())[:1]}
    run_pipeline(w.ratings, w.items, cfg, out=out, fmt="parquet", publish=False, resume_key="injected", assignments=first).release()
    run_pipeline(w.ratings, w.items, cfg, out=out, fmt="parquet", resume_key="injected", assignments=cuts).release()
    taken = committed(spark, out)["about"]["taken_over"]
    users = spark.read.parquet(f"{out}/recommendations_topn").groupBy("k").agg(F.count(F.lit(1)).alias("recommended"))
    return spark.read.parquet(f"{out}/metrics_summary").join(users, "k").select(
        "k", _r("precision_at_k"), _r("recall_at_k"), "evaluated_users", "recommended", F.col("k").isin(taken).alias("taken_over"))


def _lines_with_broken_ones(spark, sf_dir) -> str:
    ratings = _w(spark, sf_dir).ratings
    path = scratch_path(spark, "ratings-lines")
    lines = render_ratings_lines(ratings)
    broken = render_ratings_lines(ratings.filter("userId % 10 = 0")).select(F.concat(F.lit("u"), "value").alias("value"))
    lines.unionByName(broken).write.mode("overwrite").text(path)
    return path


def q_parse_ratings_lines(spark, sf_dir):
    return read_ratings(spark, _lines_with_broken_ones(spark, sf_dir), mode="dropmalformed")


def q_quarantine_ratings(spark, sf_dir):
    return quarantine_ratings(read_ratings(spark, _lines_with_broken_ones(spark, sf_dir)))


_QUERIES = {
    "profile": q_profile,
    "split_profile": q_split_profile,
    "rating_distribution": q_rating_distribution,
    "hash_split_train": q_hash_split_train,
    "hash_split_test": q_hash_split_test,
    "hash_split_negative": q_hash_split_negative,
    "hash_split_fraction": q_hash_split_fraction,
    "random_split": q_random_split,
    "item_genres": q_item_genres,
    "item_genres_table": q_item_genres_table,
    "profile_sketches": q_profile_sketches,
    "user_features": q_user_features,
    "scaled_features": q_scaled_features,
    "assign_nearest": q_assign_nearest,
    "kmeans_assign": q_kmeans_assign,
    "kmeans_invariants": q_kmeans_invariants,
    "kmeans_sweep_metrics": q_kmeans_sweep_metrics,
    "kmeans_costs": q_kmeans_costs,
    "cluster_stats": q_cluster_stats,
    "describe_clusters": q_describe_clusters,
    "describe_clusters_all_labels": q_describe_clusters_all_labels,
    "cluster_item_scores": q_cluster_item_scores,
    "cluster_item_scores_layout": q_cluster_item_scores_layout,
    "cluster_item_ranks": q_cluster_item_ranks,
    "cluster_genres": q_cluster_genres,
    "top_genres": q_top_genres,
    "seen_items": q_seen_items,
    "seen_items_null_rating": q_seen_items_null_rating,
    "unseen_candidates": q_unseen_candidates,
    "recommend_topn": q_recommend_topn,
    "recommend_topn_blocked": q_recommend_topn_blocked,
    "recommend_topn_large": q_recommend_topn_large,
    "sample_recommendations": q_sample_recommendations,
    "relevant_counts": q_relevant_counts,
    "per_user_metrics": q_per_user_metrics,
    "global_metrics": q_global_metrics,
    "metrics_summary": q_metrics_summary,
    "best_k": q_best_k,
    "documents_flat": q_documents_flat,
    "document_stats": q_document_stats,
    "preview_documents": q_preview_documents,
    "lookup_users": q_lookup_users,
    "lookup_users_pruned": q_lookup_users_pruned,
    "lookup_list": q_lookup_list,
    "missing_users": q_missing_users,
    "page_users": q_page_users,
    "page_users_deep": q_page_users_deep,
    "page_envelope": q_page_envelope,
    "duplicate_documents": q_duplicate_documents,
    "roundtrip_json": q_roundtrip_json,
    "run_k_outputs": q_run_k_outputs,
    "parse_ratings_lines": q_parse_ratings_lines,
    "quarantine_ratings": q_quarantine_ratings,
    "parse_items_lines": q_parse_items_lines,
    "parse_items_latin1": q_parse_items_latin1,
    "dedupe_items": q_dedupe_items,
    "roundtrip_documents": q_roundtrip_documents,
    "roundtrip_json_array": q_roundtrip_json_array,
    "count_documents": q_count_documents,
    "pipeline_summary": q_pipeline_summary,
    "pipeline_injected": q_pipeline_injected,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: per-user top-10 unseen items from the user's cluster, on sf0.001."""
    return q_recommend_topn(spark, SMOKE_DIR)


def _training_data() -> tuple[dict, dict]:
    """Queries and SQL of the training-data operators, if that subpackage is installed."""
    try:
        import corpus_pipeline
        from segrec.llm import queries as llm
    except ModuleNotFoundError as e:
        if e.name not in ("corpus_pipeline", "segrec.llm", "segrec.llm.queries"):
            raise
        return {}, {}
    sql = dict(llm.ORACLE_SQL)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_training_data()[0]}


# ---------------------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------------------

def _bucket(buckets: int = 10, sign: str = "") -> str:
    mod = lambda x: f"((({x}) % 1000003 + 1000003) % 1000003)"
    return (f"(({mod(sign + 'userId')} * 427799 + {mod(sign + 'movieId')} * 40503 + {mod('timestamp')})"
            f" % 1000003 % {buckets})")


_BUCKET = _bucket()

_BASE = f"""
ratings AS (
  SELECT o_custkey AS userId, l_partkey AS movieId,
         CAST(CAST(l_quantity AS BIGINT) % 5 + 1 AS DOUBLE) AS rating,
         CAST(epoch(l_shipdate) AS BIGINT) AS timestamp
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
items AS (
  SELECT p_partkey AS movieId, p_name AS title,
         p_type || '|' || replace(p_name, ' ', '|') AS genres
  FROM part),
train AS (SELECT * FROM ratings WHERE {_BUCKET} < 8),
test AS (SELECT * FROM ratings WHERE {_BUCKET} >= 8),
uf AS (SELECT userId, count(movieId) AS movies_rated, avg(rating) AS avg_rating
       FROM train GROUP BY userId)"""


def _uc(thresholds=(25, 40), name="uc"):
    terms = " + ".join(f"CAST(movies_rated > {t} AS BIGINT)" for t in thresholds)
    return f"{name} AS (SELECT userId, movies_rated, avg_rating, CAST({terms} AS BIGINT) AS cluster FROM uf)"


def _scores(uc="uc", name="cs"):
    return f"""{name} AS (
  SELECT cluster, movieId, avg(rating) AS cluster_avg_movie_rating,
         count(rating) AS cluster_rating_count,
         avg(rating) * ln(1 + count(rating)) AS recommendation_score
  FROM train JOIN {uc} USING (userId) GROUP BY cluster, movieId)"""


def _recs(uc="uc", cs="cs", name="recs", top_n=10):
    return f"""{name} AS (
  SELECT r.userId, r.cluster, r.movieId, i.title, i.genres, r.cluster_avg_movie_rating,
         r.cluster_rating_count, r.recommendation_score, r.rank
  FROM (SELECT u.userId, u.cluster, c.movieId, c.cluster_avg_movie_rating,
               c.cluster_rating_count, c.recommendation_score,
               row_number() OVER (PARTITION BY u.userId ORDER BY c.recommendation_score DESC,
                                  c.cluster_rating_count DESC, c.movieId ASC) AS rank
        FROM {uc} u JOIN {cs} c ON u.cluster = c.cluster
        WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.userId = u.userId AND t.movieId = c.movieId)) r
  LEFT JOIN items i ON i.movieId = r.movieId
  WHERE r.rank <= {top_n})"""


def _relevant(name="rel"):
    return f"{name} AS (SELECT DISTINCT userId, movieId FROM test WHERE rating >= 4.0)"


def _per_user(recs="recs", rel="rel", name="pu", top_n=10):
    return f"""{name} AS (
  SELECT rel.userId, count(*) AS relevant_count, count(r.movieId) AS hits,
         count(r.movieId) / {top_n} AS precision_at_k, count(r.movieId) / count(*) AS recall_at_k
  FROM {rel} rel LEFT JOIN {recs} r ON r.userId = rel.userId AND r.movieId = rel.movieId
  GROUP BY rel.userId)"""


def _genres():
    vocab = ", ".join(f"'{g}'" for g in TABLE_GENRES)
    return f"""ig AS (
  SELECT movieId, genre FROM (SELECT movieId, unnest(string_split(genres, '|')) AS genre FROM items)
  WHERE genre IS NOT NULL AND genre IN ({vocab}))"""


def _docs_flat(recs="recs", name="df"):
    return f"""{name} AS (
  SELECT userId AS user_id, cluster, rank AS position, movieId AS movie_id, title AS movie_title,
         recommendation_score AS score
  FROM {recs})"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([_BASE.strip(), *ctes]) + "\n"


def _sweep_sql() -> str:
    ctes, selects = [], []
    for i, thresholds in enumerate(SWEEP_THRESHOLDS):
        ctes += [_uc(thresholds, f"uc{i}"), _scores(f"uc{i}", f"cs{i}"), _recs(f"uc{i}", f"cs{i}", f"recs{i}"),
                 _per_user(f"recs{i}", "rel", f"pu{i}")]
        selects.append(f"SELECT CAST({len(thresholds) + 1} AS BIGINT) AS k, avg(precision_at_k) AS precision_at_k, "
                       f"avg(recall_at_k) AS recall_at_k, count(userId) AS evaluated_users, "
                       f"CAST({i} AS BIGINT) AS ordinal FROM pu{i}")
    return _with(_relevant(), *ctes) + ", allm AS (" + " UNION ALL ".join(selects) + ")\n"


def _label_sql(col_movies: str, col_rating: str, movies=(100, 300), ratings=(3.2, 4.0)) -> tuple[str, str]:
    a0, a1, a2 = ACTIVITY_LABELS
    r0, r1, r2 = RATING_LABELS
    activity = (f"CASE WHEN {col_movies} > {movies[1]} THEN '{a0}' WHEN {col_movies} > {movies[0]} THEN '{a1}' "
                f"ELSE '{a2}' END")
    rating = (f"CASE WHEN {col_rating} >= {ratings[1]} THEN '{r0}' WHEN {col_rating} < {ratings[0]} THEN '{r1}' "
              f"ELSE '{r2}' END")
    return activity, rating


def _described_sql(activity: str, rating: str) -> str:
    return (f"SELECT cluster, {activity} AS activity, {rating} AS rating_profile, "
            f"({activity}) || '{DESCRIPTION_JOINER}' || ({rating}) AS description FROM ("
            "SELECT cluster, avg(movies_rated) AS avg_movies_rated, avg(avg_rating) AS avg_user_rating "
            "FROM uc GROUP BY cluster)")


def _nearest_sql() -> str:
    dists = [f"((movies_rated - {c[0]}) * (movies_rated - {c[0]}) + (avg_rating - {c[1]}) * (avg_rating - {c[1]}))"
             for c in FIXED_CENTERS]
    least = "least(" + ", ".join(dists) + ")"
    cases = " ".join(f"WHEN {d} = {least} THEN {i}" for i, d in enumerate(dists))
    return f"CAST(CASE {cases} END AS BIGINT)"


def _valid_metrics_sql() -> str:
    ks = ", ".join(f"(CAST({k} AS BIGINT))" for k in SWEEP_KS)
    return (f"SELECT k, n AS evaluated_users, n AS users_with_valid_metrics, true AS cost_agrees, true AS cost_falls FROM (VALUES {ks}) AS t(k), "
            "(SELECT count(DISTINCT userId) AS n FROM rel)")


def oracle_sql() -> dict[str, str]:
    rec_cols = ("userId, cluster, movieId, title, genres, round(cluster_avg_movie_rating, 6) AS "
                "cluster_avg_movie_rating, cluster_rating_count, round(recommendation_score, 6) AS "
                "recommendation_score, rank")
    activity, rating = _label_sql("avg_movies_rated", "avg_user_rating")
    flat = "SELECT user_id, cluster, position, movie_id, round(score, 6) AS score FROM df"
    paged = ("SELECT df.user_id, place, cluster, position, movie_id, round(score, 6) AS score FROM df JOIN "
             "(SELECT user_id, row_number() OVER (ORDER BY user_id) AS place FROM (SELECT DISTINCT user_id FROM df)) p "
             "ON p.user_id = df.user_id WHERE place BETWEEN 101 AND 200")
    out = {
        "profile": _with() + "SELECT count(*) AS ratings_rows, count(DISTINCT userId) AS distinct_users, "
                             "count(DISTINCT movieId) AS distinct_items, (SELECT count(*) FROM items) AS item_rows "
                             "FROM ratings",
        "split_profile": _with() + "SELECT (SELECT count(*) FROM train) AS train_rows, "
                                   "(SELECT count(*) FROM test) AS test_rows",
        "rating_distribution": _with() + "SELECT rating, count(*) AS count FROM ratings GROUP BY rating "
                                         "ORDER BY rating",
        "hash_split_train": _with() + "SELECT userId, movieId, rating, timestamp FROM train",
        "hash_split_test": _with() + "SELECT userId, movieId, rating, timestamp FROM test",
        "hash_split_negative": _with() + (
            "SELECT -userId AS userId, -movieId AS movieId, rating, timestamp, "
            f"CASE WHEN {_bucket(sign='-')} < 8 THEN 'train' ELSE 'test' END AS side FROM ratings"),
        "hash_split_fraction": _with() + (
            f"SELECT count(*) FILTER (WHERE {_bucket(100)} < 75) AS train_rows, "
            f"count(*) FILTER (WHERE {_bucket(100)} >= 75) AS test_rows FROM ratings"),
        "random_split": _with() + "SELECT userId, movieId, rating, timestamp, true AS share_is_near FROM ratings",
        "item_genres_table": _with() + (
            "SELECT movieId, genre FROM (SELECT movieId, unnest(string_split(genres, '|')) AS genre FROM items) WHERE genre IN "
            "(SELECT unnest(string_split(p_type, ' ')) FROM part UNION SELECT regexp_extract(p_name, '[^ ]*$') FROM part)"),
        "profile_sketches": _with() + (
            "SELECT count(DISTINCT year(to_timestamp(timestamp))) AS loads, count(*) AS ratings_rows, count(DISTINCT userId) AS distinct_users, "
            "count(DISTINCT movieId) AS distinct_items, true AS users_within_bound, true AS items_within_bound FROM ratings"),
        "kmeans_costs": _with() + (
            f"SELECT k, n AS users, true AS cost_agrees, true AS cost_falls FROM (VALUES {', '.join(f'(CAST({k} AS BIGINT))' for k in SWEEP_KS)}) "
            "AS t(k), (SELECT count(*) AS n FROM uf)"),
        "pipeline_injected": _sweep_sql() + (
            "SELECT k, round(precision_at_k, 6) AS precision_at_k, round(recall_at_k, 6) AS recall_at_k, evaluated_users, "
            "n AS recommended, k = 2 AS taken_over FROM allm JOIN (" + " UNION ALL ".join(
                f"SELECT CAST({len(t) + 1} AS BIGINT) AS k, count(*) AS n FROM recs{i}" for i, t in enumerate(SWEEP_THRESHOLDS)) + ") USING (k)"),
        "kmeans_assign": _with() + ("SELECT count(*) AS users, count(*) AS users_in_range, "
                                    "count(*) AS users_at_means FROM uf"),
        "kmeans_sweep_metrics": _with(_relevant()) + _valid_metrics_sql(),
        "pipeline_summary": _with(_relevant()) + _valid_metrics_sql(),
        "item_genres": _with(_genres()) + "SELECT movieId, genre FROM ig",
        "user_features": _with() + "SELECT userId, movies_rated, round(avg_rating, 6) AS avg_rating FROM uf",
        "scaled_features": _with() + (
            "SELECT userId, round((movies_rated - avg(movies_rated) OVER ()) / stddev_samp(movies_rated) OVER (), 6)"
            " AS movies_rated_scaled, round((avg_rating - avg(avg_rating) OVER ()) / stddev_samp(avg_rating) OVER (), 6)"
            " AS avg_rating_scaled FROM uf"),
        "assign_nearest": _with() + f"SELECT userId, {_nearest_sql()} AS cluster FROM uf",
        "kmeans_invariants": _with() + "SELECT count(*) AS users, count(*) > 0 AS all_nearest, count(*) = count(DISTINCT userId) AS sizes_sum_ok FROM uf",
        "cluster_stats": _with(_uc()) + (
            "SELECT cluster, round(avg(movies_rated), 6) AS avg_movies_rated, round(avg(avg_rating), 6) AS "
            "avg_user_rating, count(userId) AS num_users FROM uc GROUP BY cluster"),
        "describe_clusters": _with(_uc()) + _described_sql(activity, rating),
        "describe_clusters_all_labels": _with(_uc(LABEL_CLUSTERS)) + _described_sql(
            *_label_sql("avg_movies_rated", "avg_user_rating", LABEL_ACTIVITY, LABEL_RATING)),
        "cluster_item_scores": _with(_uc(), _scores()) + (
            "SELECT cs.cluster, cs.movieId, round(cluster_avg_movie_rating, 6) AS cluster_avg_movie_rating, "
            "cluster_rating_count, round(recommendation_score, 6) AS recommendation_score, i.title, i.genres "
            "FROM cs LEFT JOIN items i ON i.movieId = cs.movieId"),
        "cluster_item_scores_layout": _sweep_sql() + " UNION ALL ".join(
            f"SELECT CAST({len(t) + 1} AS BIGINT) AS k, cluster, movieId, round(cluster_avg_movie_rating, 6) AS cluster_avg_movie_rating, "
            f"cluster_rating_count, round(recommendation_score, 6) AS recommendation_score FROM cs{i}" for i, t in enumerate(SWEEP_THRESHOLDS)),
        "cluster_item_ranks": _with(_uc(), _scores()) + (
            "SELECT cluster, movieId, row_number() OVER (PARTITION BY cluster ORDER BY recommendation_score DESC, "
            "cluster_rating_count DESC, movieId ASC) AS cluster_rank FROM cs"),
        "cluster_genres": _with(_uc(), _genres()) + (
            "SELECT uc.cluster, ig.genre, count(*) AS count FROM train JOIN uc USING (userId) "
            "JOIN ig USING (movieId) GROUP BY uc.cluster, ig.genre"),
        "top_genres": _with(_uc(), _genres()) + (
            "SELECT cluster, genre, count, rank FROM (SELECT cluster, genre, count, row_number() OVER "
            "(PARTITION BY cluster ORDER BY count DESC, genre ASC) AS rank FROM (SELECT uc.cluster, ig.genre, "
            "count(*) AS count FROM train JOIN uc USING (userId) JOIN ig USING (movieId) "
            "GROUP BY uc.cluster, ig.genre)) WHERE rank <= 5"),
        "seen_items": _with() + "SELECT DISTINCT userId, movieId FROM train",
        "seen_items_null_rating": _with() + "SELECT DISTINCT userId, movieId FROM train",
        "unseen_candidates": _with(_uc(), _scores()) + (
            "SELECT u.userId, count(*) AS candidates FROM uc u JOIN cs c ON u.cluster = c.cluster "
            "WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.userId = u.userId AND t.movieId = c.movieId) "
            "GROUP BY u.userId"),
        "recommend_topn": _with(_uc(), _scores(), _recs()) + f"SELECT {rec_cols} FROM recs",
        "recommend_topn_blocked": _with(_uc(), _scores(), _recs()) + f"SELECT {rec_cols} FROM recs",
        "recommend_topn_large": _with(_uc(), _scores(), _recs()) + f"SELECT {rec_cols} FROM recs",
        "sample_recommendations": _with(_uc(), _scores(), _recs()) + (
            f"SELECT {rec_cols} FROM recs WHERE userId IN "
            "(SELECT DISTINCT userId FROM recs ORDER BY userId LIMIT 20) ORDER BY userId, rank"),
        "relevant_counts": _with(_relevant()) + "SELECT userId, count(movieId) AS relevant_count FROM rel GROUP BY userId",
        "per_user_metrics": _with(_uc(), _scores(), _recs(), _relevant(), _per_user()) + (
            "SELECT userId, relevant_count, hits, round(precision_at_k, 6) AS precision_at_k, "
            "round(recall_at_k, 6) AS recall_at_k FROM pu"),
        "global_metrics": _with(_uc(), _scores(), _recs(), _relevant(), _per_user()) + (
            "SELECT round(avg(precision_at_k), 6) AS precision_at_k, round(avg(recall_at_k), 6) AS recall_at_k, "
            "count(userId) AS evaluated_users FROM pu"),
        "metrics_summary": _sweep_sql() + (
            "SELECT k, round(precision_at_k, 6) AS precision_at_k, round(recall_at_k, 6) AS recall_at_k, "
            "evaluated_users, ordinal FROM allm "
            "ORDER BY precision_at_k DESC NULLS LAST, recall_at_k DESC NULLS LAST, ordinal"),
        "best_k": _sweep_sql() + (
            "SELECT k, round(precision_at_k, 6) AS precision_at_k, round(recall_at_k, 6) AS recall_at_k, "
            "evaluated_users FROM allm ORDER BY precision_at_k DESC NULLS LAST, ordinal LIMIT 1"),
        "documents_flat": _with(_uc(), _scores(), _recs(), _docs_flat()) + (
            "SELECT user_id, cluster, position, movie_id, movie_title, round(score, 6) AS score FROM df"),
        "document_stats": _with(_uc(), _scores(), _recs()) + (
            "SELECT count(*) AS users, CAST(sum(n) AS BIGINT) AS total_recommendations, min(cluster) AS min_cluster, "
            "max(cluster) AS max_cluster, round(sum(n) / count(*), 1) AS avg_per_user "
            "FROM (SELECT userId, cluster, count(*) AS n FROM recs GROUP BY userId, cluster)"),
        "preview_documents": _with(_uc(), _scores(), _recs()) + (
            "SELECT userId AS user_id, cluster, count(*) AS n_recommendations, "
            "array_to_string(list_concat("
            "  list(CASE WHEN length(coalesce(title, '')) > 30 THEN substring(coalesce(title, ''), 1, 30) || '...' "
            "            ELSE coalesce(title, '') END ORDER BY rank) FILTER (WHERE rank <= 3),"
            "  CASE WHEN count(*) > 3 THEN ['+' || CAST(count(*) - 3 AS VARCHAR) || ' más'] ELSE [] END"
            "), ' | ') AS preview "
            "FROM recs GROUP BY userId, cluster"),
        "lookup_users": _with(_uc(), _scores(), _recs(), _docs_flat()) + (
            f"{flat} WHERE user_id IN (SELECT c_custkey * 3 FROM customer)"),
        "lookup_users_pruned": _with(_uc(), _scores(), _recs(), _docs_flat()) + (
            f"{flat} WHERE user_id IN (SELECT n_nationkey * 5 + 1 FROM nation)"),
        "lookup_list": _with(_uc(), _scores(), _recs(), _docs_flat()) + (
            f"{flat} WHERE user_id IN ({', '.join(map(str, LOOKUP_IDS))})"),
        "missing_users": _with(_uc(), _scores(), _recs()) + (
            "SELECT DISTINCT c_custkey * 3 AS user_id FROM customer "
            "WHERE c_custkey * 3 NOT IN (SELECT userId FROM recs)"),
        "page_users": _with(_uc(), _scores(), _recs(), _docs_flat()) + paged,
        "page_users_deep": _with(_uc(), _scores(), _recs(), _docs_flat()) + paged,
        "page_envelope": _with(_uc(), _scores(), _recs(), _docs_flat()) + (
            "SELECT (SELECT count(DISTINCT user_id) FROM df) AS total, CAST(50 AS BIGINT) AS \"limit\", "
            "CAST(25 AS BIGINT) AS \"offset\", row_number() OVER (ORDER BY user_id) - 1 AS place, user_id, n_recommendations "
            "FROM (SELECT user_id, count(*) AS n_recommendations FROM df GROUP BY user_id ORDER BY user_id LIMIT 50 OFFSET 25)"),
        "duplicate_documents": _with(_uc(), _scores(), _recs(), _docs_flat()) + flat,
        "run_k_outputs": _with(_uc(), _scores(), _recs(), _docs_flat()) + (
            "SELECT CAST(3 AS BIGINT) AS k, user_id, cluster, position, movie_id, round(score, 6) AS score FROM df"),
        "roundtrip_json": _with(_uc(), _scores(), _recs()) + f"SELECT {rec_cols} FROM recs",
        "parse_ratings_lines": _with() + "SELECT userId, movieId, rating, timestamp FROM ratings",
        "quarantine_ratings": _with() + (
            "SELECT CAST(NULL AS BIGINT) AS userId, movieId, rating, timestamp, 'no user' AS reason "
            "FROM ratings WHERE userId % 10 = 0"),
        "parse_items_lines": _with() + "SELECT movieId, title, genres FROM items",
        "parse_items_latin1": _with() + "SELECT movieId, title || ' é ñ ü ß' || movieId AS title, genres FROM items",
        "dedupe_items": _with() + "SELECT movieId, title, genres FROM items",
        "roundtrip_documents": _with(_uc(), _scores(), _recs(), _docs_flat()) + (
            "SELECT user_id, cluster, position, movie_id, movie_title, round(score, 6) AS score FROM df"),
        "roundtrip_json_array": _with(_uc(), _scores(), _recs(), _docs_flat()) + (
            "SELECT user_id, cluster, position, movie_id, movie_title, round(score, 6) AS score FROM df"),
        "count_documents": _with(_uc(), _scores(), _recs()) + (
            "SELECT count(DISTINCT userId) AS total_users FROM recs"),
    }
    return {**out, **_training_data()[1]}
