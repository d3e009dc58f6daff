"""Composite plans: one run for a given clustering (``run_k``) and the whole sweep
(``run_pipeline``): load -> profile -> split -> features -> scale -> for each K: fit, assign,
score, recommend, evaluate, sample -> compare K -> write.

The rating table is aggregated once to user-item pairs and relevant test pairs, and joined
once with a users table that holds the clusters of every K; a run only groups by its own
cluster column. Tables shared by the runs are persisted (with ``checkpoint=True`` the pairs
are checkpointed into the shared ``spark.checkpoint.dir``, so a lost executor never replays
the load and split) and released by ``PipelineResult.release``.

With an output folder every table is staged and all are published together (``sinks.staged``):
a sweep that ends early leaves the last result whole. The same sweep started again, with the
same input files, plans and configuration, takes over each K that was finished, starts no fit for it, and reads
the user features that the broken one had written, so the other K's meet the same rows in the same files.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.storagelevel import StorageLevel

from segrec.config import RunConfig
from segrec.operators.clusters import cost_agreement, describe_clusters, fit_sweep, training_cost
from segrec.operators.evaluate import evaluate, global_metrics, relevant_items
from segrec.operators.features import clusterable, scale_features
from segrec.operators.layout import UserLayout
from segrec.operators.prepare import explode_genres, hash_split, profile, random_split, rating_distribution, split_profile
from segrec.operators.recommend import longest_history, rank_items, recommend, sample_recommendations
from segrec.operators.scoring import (
    cluster_genres,
    cluster_item_scores,
    cluster_stats,
    clusters_of,
    pairs_of,
    relevant_of,
    split_pairs,
    top_genres,
    user_features_from_pairs,
    user_item_pairs,
    with_clusters,
)
from segrec.operators.sweep import best_k, metrics_summary, union_metrics
from segrec.session import cut_lineage, stored
from segrec.operators.serving import pack_documents
from segrec.sinks import write_documents, write_table
from segrec.sinks.staged import StagedOutput, input_key, recover
from segrec.sources.text import dedupe_items, quarantine_ratings, usable_ratings

_LEVEL = StorageLevel.MEMORY_AND_DISK


@dataclass
class RunResult:
    k: int
    user_clusters: DataFrame
    cluster_stats: DataFrame
    cluster_descriptions: DataFrame
    cluster_genres: DataFrame | None
    top_genres: DataFrame | None
    scores: DataFrame | None  # not among the tables: None for a K taken over from a broken sweep
    recommendations: DataFrame
    sample_recommendations: DataFrame
    per_user_metrics: DataFrame
    global_metrics: DataFrame
    model: object = None
    cost: float | None = None
    _cached: list = field(default_factory=list)

    def tables(self) -> dict[str, DataFrame]:
        """The per-run output tables, each with a ``k`` column."""
        k = F.lit(self.k).cast("bigint")
        more = {} if self.top_genres is None else {
            "cluster_genres": self.cluster_genres.withColumn("k", k), "top_genres": self.top_genres.withColumn("k", k)}
        # The names of the seven tables of a run; two descriptive ones are added.
        return {
            "user_clusters": self.user_clusters.withColumn("k", k),
            "cluster_stats": self.cluster_stats.withColumn("k", k),
            "cluster_descriptions": self.cluster_descriptions.withColumn("k", k),
            **more,
            "recommendations_topn": self.recommendations.withColumn("k", k),
            "sample_recommendations_20_users": self.sample_recommendations.withColumn("k", k),
            "per_user_metrics": self.per_user_metrics.withColumn("k", k),
            "metrics": self.global_metrics,
        }

    def release(self) -> None:
        for df in self._cached:
            df.unpersist()
        self._cached.clear()


def run_k(train: DataFrame, test: DataFrame, user_clusters: DataFrame, k: int,
          items: DataFrame | None = None, item_genres: DataFrame | None = None,
          cfg: RunConfig = RunConfig(), model=None, cost: float | None = None,
          relevant: DataFrame | None = None, rated: DataFrame | None = None, longest: int | None = None) -> RunResult:
    """Everything that follows a cluster assignment (``user_clusters``: userId, cluster,
    movies_rated, avg_rating). Taking the assignment as input lets tests inject one.
    ``train`` may be the rating rows or their ``user_item_pairs`` (shared across a sweep);
    ``relevant`` may pass the persisted relevant test pairs and ``rated`` the run's
    persisted ``with_clusters`` table (``clusters_of`` a sweep's, which is kept once for all runs),
    ``longest`` its ``longest_history``."""
    cached = []
    if rated is None:
        rated = with_clusters(train, user_clusters).persist(_LEVEL)
        cached.append(rated)
    ranked = rank_items(cluster_item_scores(rated)).persist(_LEVEL)
    recs = recommend(rated, user_clusters, ranked, items, cfg.top_n, ranked=ranked, longest=longest).persist(_LEVEL)
    global_m, per_user = evaluate(recs, test, cfg.top_n, cfg.relevance_threshold, relevant=relevant)
    per_user = per_user.persist(_LEVEL)
    global_m = (global_metrics(per_user).withColumn("k", F.lit(k).cast("bigint"))
                .withColumn("training_cost", F.lit(cost).cast("double")))
    stats = cluster_stats(user_clusters)
    genres = cluster_genres(rated, item_genres) if item_genres is not None else None
    return RunResult(
        k=k, user_clusters=user_clusters, cluster_stats=stats,
        cluster_descriptions=describe_clusters(stats),
        cluster_genres=genres, top_genres=top_genres(genres, cfg.top_genres) if genres is not None else None,
        scores=ranked, recommendations=recs,
        sample_recommendations=sample_recommendations(recs, cfg.sample_users),
        per_user_metrics=per_user, global_metrics=global_m, model=model, cost=cost,
        _cached=[*cached, ranked, recs, per_user],
    )


@dataclass
class PipelineResult:
    """Results of a sweep. ``runs`` holds every K's tables (descriptions, top genres,
    recommendations, ...), ``best_sample`` the sample of the best K. They are lazy on top of
    persisted tables until ``release``, which also ends what was persisted for the sweep."""

    profile: DataFrame
    rating_distribution: DataFrame
    split_profile: DataFrame
    metrics: DataFrame
    summary: DataFrame
    best: DataFrame
    best_sample: DataFrame
    quarantine: DataFrame
    runs: dict[int, RunResult]
    costs: DataFrame | None = None  # ``cost_agreement`` of the K's that were fitted
    written: list = field(default_factory=list)
    _cached: list = field(default_factory=list)
    _layouts: list = field(default_factory=list)

    def release(self) -> None:
        for run in self.runs.values():
            run.release()
        for df in self._cached:
            df.unpersist()
        self._cached.clear()
        for layout in self._layouts:
            layout.drop()
        self._layouts.clear()


def prepare_inputs(ratings: DataFrame, items: DataFrame, cfg: RunConfig):
    """Usable rows, de-duplicated items and the train/test split: the raw splits are read once
    each, into their aggregates (user-item pairs, relevant pairs), which are the tables kept
    for the sweep. Lazy, but for the checkpoint that a random split is cut from."""
    ratings = usable_ratings(ratings)
    items = dedupe_items(items)
    if cfg.split == "hash":
        train, test = hash_split(ratings, cfg.train_fraction, cfg.split_buckets)
    else:
        train, test = random_split(ratings, (cfg.train_fraction, 1 - cfg.train_fraction), cfg.seed)
    return ratings, items, train, test


def _written_run(spark, k: int, done: dict, folder: Callable[[str], str], fmt: str) -> RunResult:
    """A finished run from the tables that it wrote."""
    def read(name):
        if name not in done["schemas"]:
            return None
        return getattr(spark.read.schema(StructType.fromJson(done["schemas"][name])), fmt)(folder(f"{name}/k={k}"))

    return RunResult(
        k=k, user_clusters=read("user_clusters"), cluster_stats=read("cluster_stats"),
        cluster_descriptions=read("cluster_descriptions"), cluster_genres=read("cluster_genres"), top_genres=read("top_genres"),
        scores=None, recommendations=read("recommendations_topn"), sample_recommendations=read("sample_recommendations_20_users"),
        per_user_metrics=read("per_user_metrics"), cost=done["cost"],
        global_metrics=read("metrics").select("precision_at_k", "recall_at_k", "evaluated_users", F.lit(k).cast("bigint").alias("k"), "training_cost"))


def _write_run(result: RunResult, stage: StagedOutput, fmt: str, parallelism: int) -> None:
    """Stage the tables of one run and record that it is finished.

    The recommendations go first, which fills the persisted tables that the others read; the others are
    independent jobs and are submitted together."""
    tables = result.tables()

    def write(name):
        write_table(tables[name].drop("k"), stage.path(f"{name}/k={result.k}"), fmt)

    write("recommendations_topn")
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        list(pool.map(write, [name for name in tables if name != "recommendations_topn"]))
    stage.finish(f"k={result.k}", {"cost": result.cost, "schemas": {n: df.drop("k").schema.jsonValue() for n, df in tables.items()}})


def sweep_key(ratings: DataFrame, items: DataFrame, cfg: RunConfig, fmt: str) -> str:
    """What a sweep is known by when it is started again: its configuration but for the K's (each K
    is finished on its own) and how much is done at a time, and its input."""
    asked = {k: v for k, v in asdict(cfg).items() if k not in ("k_values", "fit_parallelism", "write_parallelism", "user_buckets", "hot_user_rows")}
    return hashlib.sha256(json.dumps([asked, fmt, input_key(ratings, items)]).encode()).hexdigest()[:32]


def run_pipeline(ratings: DataFrame, items: DataFrame, cfg: RunConfig = RunConfig(),
                 out: str | None = None, fmt: str = "json", checkpoint: bool = False,
                 documents_k: int | str | None = None, resume: bool = True, publish: bool = True, resume_key: str | None = None,
                 assignments: Mapping[int, Callable[[DataFrame], DataFrame]] | None = None) -> PipelineResult:
    """The whole sweep. With ``out``, every per-K table is written to ``<out>/<name>/k=<K>``,
    the summary to ``<out>/metrics_summary`` and rating rows without a user or item to
    ``<out>/quarantine``; ``documents_k`` (a K of the sweep, or ``"best"``) also packs that K's
    recommendations into served documents at ``<out>/documents``. All of it is published at the end;
    with ``publish=False`` the runs stay staged, for a later call of the same key to take over and publish;
    ``resume=False`` begins anew where an earlier attempt was left.

    ``assignments`` (K -> function that adds ``cluster`` to the user features) takes the place of the
    K-Means fits, so that a known clustering goes through the whole pipeline. What functions do, or rows
    that come from no file, can't be known again: such a sweep is taken over only under a ``resume_key``
    of the caller's (letters and digits) that stands for its input, configuration and functions."""
    spark = ratings.sparkSession
    ks = tuple(assignments) if assignments is not None else tuple(dict.fromkeys(cfg.k_values))
    if documents_k not in (None, "best") and int(documents_k) not in ks:
        raise ValueError(f"documents_k {documents_k} is none of the sweep's {list(ks)}")
    stage, done = None, {}
    if out:
        recover(spark, out)
        if resume_key is None:
            resume_key = uuid.uuid4().hex if assignments is not None else sweep_key(ratings, items, cfg, fmt)
        stage = StagedOutput(spark, out, resume_key)
        if not resume:
            stage.discard()
        done = {k: found for k in ks if (found := stage.finished(f"k={k}"))}
    pending = [k for k in ks if k not in done]

    quarantine = quarantine_ratings(ratings)
    ratings, items, train, test = prepare_inputs(ratings, items, cfg)
    kept, layouts = [], []

    def persisted(df: DataFrame) -> DataFrame:
        kept.append(df.persist(_LEVEL))
        return df

    runs: dict[int, RunResult] = {k: _written_run(spark, k, found, stage.path, fmt) for k, found in done.items()}
    # metrics are tiny: keep them as checkpoints so the summary does not replay the runs
    metrics = {k: cut_lineage(run.global_metrics) for k, run in runs.items()}
    costs = None
    if pending:
        item_genres = persisted(explode_genres(items, cfg.genre_vocabulary, cfg.normalize_genres))
        # a staged sweep keeps the tables that it could not (random split) or should not compute again
        table = stage.keep if stage else stored
        keep = table if checkpoint or (stage and cfg.split == "random") else lambda df, name: persisted(df)
        if cfg.split == "hash":
            # the hash split is a per-row predicate: one scan and one shuffle give both sides
            split = keep(split_pairs(ratings, cfg.train_fraction, cfg.relevance_threshold, cfg.split_buckets), "split")
            pairs, relevant = pairs_of(split), relevant_of(split)
        else:
            pairs = keep(user_item_pairs(train), "pairs")
            relevant = keep(relevant_items(test, cfg.relevance_threshold), "relevant")
        layout = None
        if cfg.user_buckets:
            layout = UserLayout.store(pairs, cfg.user_buckets, cfg.hot_user_rows)
            layouts.append(layout)
            pairs = layout.pairs()
        # one row per user, written once: K-Means reads it every iteration
        features = table(clusterable(layout.features() if layout else user_features_from_pairs(pairs)), "features")
        models, users = {}, features
        if assignments is None:
            users = scaled = persisted(scale_features(features))
            models = fit_sweep(scaled, pending, cfg.seed, parallelism=cfg.fit_parallelism)
            costs = cost_agreement(models, scaled)
        for k in pending:
            users = (models[k].transform(users).withColumnRenamed("prediction", "cluster") if models else assignments[k](users))
            users = users.withColumn(f"cluster_{k}", F.col("cluster").cast("bigint")).drop("cluster")
        columns = tuple(f"cluster_{k}" for k in pending)
        users = stored(users.select("userId", "movies_rated", "avg_rating", *columns), "users")
        tagged = persisted(layout.with_clusters(users, columns) if layout else with_clusters(pairs, users, columns))
        longest = longest_history(tagged)
        for k in pending:
            user_clusters = users.select("userId", F.col(f"cluster_{k}").alias("cluster"), "movies_rated", "avg_rating")
            result = runs[k] = run_k(pairs, test, user_clusters, k, items, item_genres, cfg, model=models.get(k),
                                     cost=training_cost(models[k]) if models else None, relevant=relevant,
                                     rated=clusters_of(tagged, f"cluster_{k}"), longest=longest)
            if stage:
                _write_run(result, stage, fmt, cfg.write_parallelism)
            metrics[k] = cut_lineage(result.global_metrics)

    all_metrics = union_metrics([metrics[k] for k in ks])
    summary = metrics_summary(all_metrics)
    best = int(best_k(all_metrics).first()["k"])
    written = []
    if stage and publish:
        names = ["metrics_summary", "quarantine"]
        write_table(summary.drop("ordinal"), stage.path("metrics_summary"), fmt)
        write_table(quarantine, stage.path("quarantine"), fmt)
        if documents_k is not None:
            chosen = best if documents_k == "best" else int(documents_k)
            write_documents(pack_documents(runs[chosen].recommendations), stage.path("documents"), fmt)
            names.append("documents")
        tables = [f"{name}/k={k}" for k in ks for name in _table_names(stage, k)] + names
        found = {k: stage.finished(f"k={k}") for k in done}
        stage.publish(tables, {"k_values": list(ks), "best": best, "format": fmt, "taken_over": sorted(done)})
        written = [f"{out.rstrip('/')}/{table}" for table in tables]
        # runs taken over are read from where their tables are now
        runs.update({k: _written_run(spark, k, value, lambda table: f"{out.rstrip('/')}/{table}", fmt) for k, value in found.items()})
    runs = {k: runs[k] for k in ks}
    return PipelineResult(profile=profile(ratings, items), rating_distribution=rating_distribution(ratings),
                          split_profile=split_profile(train, test), metrics=all_metrics, summary=summary,
                          best=best_k(all_metrics), best_sample=runs[best].sample_recommendations,
                          quarantine=quarantine, runs=runs, costs=costs, written=written, _cached=kept, _layouts=layouts)


def _table_names(stage: StagedOutput, k: int) -> list[str]:
    return list(stage.finished(f"k={k}")["schemas"])
