"""Corpus pipeline: documents through five of the training-data operators.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's docs. All but the last
return the columns of ``documents``.

Decisions: the quality classifier drops what it rejects; of a group of near-duplicates (five
words, similarity 0.8) the row with the smallest id stays (a null id is the largest); passages of 50 words that occur
more than once are cut from what is left (a document of which nothing remains goes); documents
that overlap a benchmark item go; the last stage gives the piece ids of what was kept.

Every stage judges rows, not ids: a null doc_id is judged like any other, and rows that share one are
judged each by its own text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segrec.llm import decontam, minhash, nbest, quality, substring
from segrec.llm.common import chunk_table, ensure_importable, materialise, row_number_in_chunks, rows_of_chunks
from segrec.llm.queries import piece_model, table
from segrec.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(rows: DataFrame) -> DataFrame:
    """The columns of ``documents`` from an operator's ``row`` struct and its text."""
    return rows.select("row.doc_id", "text", "row.lang", "row.source", F.length("text").cast("long").alias("n_chars"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = quality.score_documents(docs.select(*COLUMNS), table(spark, sf_dir, "labels"), with_text=True)
    return scored.where("kept").select("row.doc_id", "text", "row.lang", "row.source", "row.n_chars")


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    columns = docs.select(*COLUMNS).schema
    chunks, _ = chunk_table(docs.select(*COLUMNS))
    groups = minhash.grouped_rows(chunks, row_number_in_chunks(), shingle=5, percent=80)
    # a group is as large as it may be: its first row is found by a minimum, combined in the map tasks
    named = groups.select("chunk", "nth", "component_id").join(chunks.select("chunk", "nth", "row.doc_id"), ["chunk", "nth"])
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "chunk", "nth"))
    stays = named.groupBy("component_id").agg(first.alias("first")).select("first.chunk", "first.nth")
    return rows_of_chunks(chunks, stays, columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substring.remove_repeats(docs.select(*COLUMNS), width=50)
    return _documents(cut.where("n_removed < n_words or n_words = 0"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # what is decided depends on the text alone, so rows are told by its digest
    digest = F.unhex(F.md5(F.col("text"))).alias("digest")
    overlaps = decontam.find_overlaps(docs.select(digest, "text"), table(spark, sf_dir, "benchmark"))
    # written first: its size is known when the join is planned
    gone = materialise(overlaps.select("row.digest").distinct(), "leaked")
    return docs.select(*COLUMNS).withColumn("digest", digest).join(gone, "digest", "left_anti").select(*COLUMNS)


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = nbest.encode_documents(docs, piece_model(), n_best=4)
    return encoded.select("doc_id", "n_pieces", "piece_ids", "best_ids", "nbest_scores", "round_trip")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece_encoding", sentencepiece_encoding),
]

# Language-model scoring, lattice search and shingle components are not SQL-expressible;
# tests/llm compares every stage with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_importable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
    return docs
