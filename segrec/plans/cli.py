"""Command line: ``python -m segrec.plans.cli --dataset-path DIR --output-dir OUT``.

``DIR`` holds ``ratings.dat`` and ``movies.dat`` (``::``-delimited) on any Hadoop file
system; ``--parquet-tables DIR`` uses the ratings/items views over Parquet tables instead.
"""

from __future__ import annotations

import argparse

from segrec.config import RunConfig, parse_k_values
from segrec.plans.pipeline import run_pipeline
from segrec.session import build_session
from segrec.sources.tables import TABLE_GENRES, items_from_tables, ratings_from_tables
from segrec.sources.text import read_items, read_ratings


def parse_args(argv=None):
    cfg = RunConfig()
    p = argparse.ArgumentParser(description="Fit user segments for each K, recommend unseen items per segment, compare the Ks.")
    p.add_argument("--dataset-path", default="ml-1m")
    p.add_argument("--parquet-tables", default=None)
    p.add_argument("--output-dir", default="output/cluster-recommender")
    p.add_argument("--k-values", default=",".join(map(str, cfg.k_values)))
    p.add_argument("--top-n", type=int, default=cfg.top_n)
    p.add_argument("--relevance-threshold", type=float, default=cfg.relevance_threshold)
    p.add_argument("--seed", type=int, default=cfg.seed)
    p.add_argument("--split", choices=("hash", "random"), default=cfg.split)
    p.add_argument("--train-fraction", type=float, default=cfg.train_fraction)
    p.add_argument("--split-buckets", type=int, default=cfg.split_buckets)
    p.add_argument("--items-encoding", default="ISO-8859-1")
    p.add_argument("--format", choices=("json", "parquet"), default="json")
    p.add_argument("--checkpoint", action="store_true")
    p.add_argument("--user-buckets", type=int, default=cfg.user_buckets, help="store the pairs by user in so many buckets")
    p.add_argument("--no-resume", action="store_true", help="begin anew where an earlier attempt broke off")
    p.add_argument("--documents-k", default=None,
                   help="pack this K's recommendations (or 'best') into <output-dir>/documents")
    p.add_argument("--master", default=None)
    return p.parse_args(argv)


def main(argv=None, stop: bool = True) -> None:
    args = parse_args(argv)
    spark = build_session(master=args.master, app_name="segrec-pipeline")
    if args.parquet_tables:
        ratings = ratings_from_tables(spark, args.parquet_tables)
        items = items_from_tables(spark, args.parquet_tables)
        vocabulary = TABLE_GENRES
    else:
        ratings = read_ratings(spark, f"{args.dataset_path}/ratings.dat")
        items = read_items(spark, f"{args.dataset_path}/movies.dat", encoding=args.items_encoding)
        vocabulary = RunConfig().genre_vocabulary
    cfg = RunConfig(k_values=parse_k_values(args.k_values), top_n=args.top_n,
                    relevance_threshold=args.relevance_threshold, seed=args.seed, split=args.split,
                    train_fraction=args.train_fraction, split_buckets=args.split_buckets,
                    genre_vocabulary=vocabulary, user_buckets=args.user_buckets)
    documents_k = args.documents_k
    if documents_k not in (None, "best"):
        documents_k = int(documents_k)
    result = run_pipeline(ratings, items, cfg, out=args.output_dir, fmt=args.format,
                          checkpoint=args.checkpoint, documents_k=documents_k, resume=not args.no_resume)
    result.summary.show(truncate=False)
    result.best.show(truncate=False)
    result.release()
    if stop:
        spark.stop()


if __name__ == "__main__":
    main()
