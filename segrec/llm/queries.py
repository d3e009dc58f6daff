"""The registered queries ``opN_<name>``, one per operator; their DuckDB SQL is in ``oracles.py``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segrec.llm import bytepair, chat, decontam, merkle, minhash, nbest, quality, rpforest, runs, shards, substring, tokencount, warc
from segrec.llm.common import ensure_importable
from segrec.llm.oracles import ORACLE_SQL


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """A public vocabulary file; its place is looked up, never copied."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def piece_model() -> str:
    return vocabulary("piece_bpe_32k.model")


def op1_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame([(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")],
                                  "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_tree(turns))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = substring.remove_repeats(docs, width=35)
    # one space between words: white space of the kept text normalised as the contract asks
    words = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return cut.select("row.doc_id", "n_words", "n_removed",
                      F.sha2(F.regexp_replace(words, "^ | $", ""), 256).alias("kept_sha256"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("row.doc_id", "row.lang", "n_bytes", F.round("perplexity", 4).alias("perplexity"),
                         F.round(F.exp("threshold"), 4).alias("perplexity_limit"), "kept")


def op4_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbest.encode_digests(table(spark, sf_dir, "documents"), piece_model(), n_best=4)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.find_overlaps(docs, table(spark, sf_dir, "benchmark"))
    return found.groupBy(F.col("row.doc_id").alias("doc_id"), "item_id").agg(
        F.max("n_words").alias("n_words"), F.max("n_equal").alias("n_equal"))


def op6_warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.archive_pages(table(spark, sf_dir, "pages"), min_revisit=100)
    chunks = warc.read_chunks(manifest, payloads=False)
    return chunks.where("is_last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                                          (F.col("chunk_no") + 1).alias("n_chunks"))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), piece_model(), limit=4096)


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rpforest.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(table(spark, sf_dir, "documents"), n_shards=8)


def _with_planted_tails(docs: DataFrame) -> DataFrame:
    """Every tenth document by the hash of its id repeats some of its words from a place on."""
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), F.floor(h / 10).alias("g"))
    docs = docs.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    docs = docs.withColumn("p", F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)) + 1)
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    tailed = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n").cast("long") - 1), lambda i: F.get("words", place(i).cast("int")))
    return docs.select("doc_id", F.when(F.col("n") > 0, F.array_join(tailed, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(_with_planted_tails(table(spark, sf_dir, "documents")), least=12)
    first = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    return found.withColumn("best", first).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div -best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = merkle.leaves(table(spark, sf_dir, "documents"), ("doc_id", "source", "lang", "n_chars", "text"), "doc_id", "lang",
                         changed={"n_chars": F.col("n_chars") + 1}, when=tampered)
    found = merkle.build(rows).rows().withColumn(
        "folded_root", F.coalesce("version_root", merkle.folded(F.col("leaf"), F.col("path"))))
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), "")
    return found.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
                        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_bpe_rank_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("byte_bpe_50k.json")
    decoded = bytepair.decode_documents(bytepair.encode_documents(table(spark, sf_dir, "documents"), path), path)
    return decoded.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


__all__ = ["ORACLE_SQL", "QUERIES", "piece_model", "table"]

QUERIES = {
    "op1_chat_tree": op1_chat_tree,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_sentencepiece_nbest": op4_sentencepiece_nbest,
    "op5_decontamination": op5_decontamination,
    "op6_warc_records": op6_warc_records,
    "op7_minhash_dedup": op7_minhash_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_sharding": op10_sharding,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_bpe_rank_array": op13_bpe_rank_array,
}
