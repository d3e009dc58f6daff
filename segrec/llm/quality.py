"""Quality by perplexity under an interpolated modified Kneser-Ney model.

The model is over bytes (order ``order``, with ``order - 1`` zero bytes before each text), so
n-grams are whole numbers: a context is a shift and a shorter n-gram is a mask, and all counts
are ordinary aggregates and joins. It is trained on all trusted texts. Each text belongs to one
of two folds by its hash and is scored by the model of the other fold, so no text, and no exact
copy, is scored by a model that saw it.

1. Documents are written once as chunks. Each chunk sends its distinct n-grams per fold, with
   their counts in trusted texts, as fragments dealt by shard of the n-gram.
2. The fragments of a shard are merged to counts. From them: continuation counts of the lower
   orders, discounts from the counts of counts, and context weights, per fold. One join per
   order and table gives the interpolated probability of every distinct n-gram in use.
3. The shards answer each fragment; each chunk adds up the log-probabilities of its documents.
4. A document's score is its log-perplexity per byte less ``z`` standard errors, so a short
   text is not rejected for the noise of a few bytes. The threshold of a language is the
   ``quantile`` of the scores of its trusted texts plus ``margin`` of its distance from their
   median; languages without trusted texts (or null) take that of all trusted texts. Documents
   above it are rejected.

5. A second model of the same kind is trained on the texts labelled toxic, by the same shards
   and folds. A document's toxicity is the largest sum, over windows of ``WINDOW`` bytes, of the
   log-likelihood ratio of the two models of the other fold, so a few words in good prose count
   in full however long the text. Its limit is formed as the threshold is, but with a margin
   that grows where fewer than ``1 / (1 - quantile)`` trusted texts are scored (their largest
   toxicity is no such quantile yet); documents above it are rejected. The label of a document itself decides nothing. Without toxic texts in the
   other fold a document has no toxicity and the perplexity alone decides.

What is counted and joined grows with the corpus; nothing is sampled and only counts of counts
(sixteen numbers per order) and the two limits of all languages reach the driver.

Defined results: a null or empty text has no perplexity and is kept (nothing speaks against
it); with no trusted text at all there is no threshold and everything is kept; labels that are
null, repeated or without a document: a document is trusted if any of its rows says quality 1
and none says quality 0 or toxic 1, and toxic if any says toxic 1; null doc_ids are neither; repeated rows are scored
each; an empty table gives an empty result; other columns come back in the struct ``row``.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from segrec.llm.common import CHUNK_BYTES, bucket_count, bucketed, chunk_table, give_back, materialise, pick

SHARD_GRAMS = 1 << 20
SALTS = 64
LEAST_DISCOUNT = 0.05  # below it a context would keep no mass for what it was not seen with
WINDOW = 16     # bytes of the window whose log-likelihood ratio is the toxicity
RATIO_STEPS = 12  # a log-likelihood ratio of a byte is sent as one signed byte, in twelfths of a nat: held within 127 of them (10.6 nats)


class ChunkGrams:
    """All n-grams of a chunk's texts: the distinct ones (with the fold of the text above the
    bytes), and per text position which one it is and whose."""

    def __init__(self, texts: list[bytes | None], order: int):
        texts = [t or b"" for t in texts]
        self.lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.fold = np.array([xxhash.xxh3_64_intdigest(t) & 1 for t in texts], dtype=np.int64)
        pad = bytes(order - 1)
        data = np.frombuffer(pad + pad.join(texts), dtype=np.uint8)
        grams = np.zeros(len(data) - order + 1, dtype=np.int64)
        for k in range(order):
            grams = grams << 8 | data[k:len(grams) + k]
        # drop the grams that end in the padding between two texts
        keep = np.ones(len(grams), dtype=bool)
        ends = np.cumsum(self.lengths + order - 1)[:-1] - (order - 1)
        for k in range(order - 1):
            keep[ends + k] = False
        grams = grams[keep] if len(texts) > 1 else grams
        del data, keep
        self.doc = np.repeat(np.arange(len(texts), dtype=np.int32), self.lengths)
        # the fold is the leading bit above the bytes
        grams |= (self.fold << (8 * order))[self.doc]
        codes, distinct = pd.factorize(grams)
        del grams
        places = np.argsort(distinct)
        self.distinct = distinct[places]
        rank = np.empty(len(distinct), dtype=np.int32)
        rank[places] = np.arange(len(distinct), dtype=np.int32)
        self.which = rank[codes]


def _by_shard(distinct: np.ndarray, order: int, shards: int):
    """((fold, shard), places): the distinct grams of a chunk dealt by fold and shard, ascending.

    The shard depends on all but the last two bytes, so the grams of a fragment lie close
    together (few bytes per step), and at most 65,536 grams share one prefix."""
    prefix = (distinct & ((1 << (8 * order)) - 1)) >> 16
    mixed = (prefix.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    fold = distinct >> (8 * order)
    dealt = fold * shards + (mixed % np.uint64(shards)).astype(np.int64)
    places = np.argsort(dealt, kind="stable")
    for run in np.split(places, np.flatnonzero(np.diff(dealt[places])) + 1) if len(places) else []:
        yield divmod(int(dealt[run[0]]), shards), run


def _marked(nth: pa.ChunkedArray, labelled: pa.Table, kind: str) -> np.ndarray:
    """Which documents of a chunk have the mark ``kind``."""
    return np.isin(nth.to_numpy(), labelled.filter(labelled[kind])["nth"].to_numpy())


def strongest_window(values: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """Per text the largest sum of ``width`` neighbouring values (fewer at its begin), 0 if it is empty."""
    running = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    ends = np.cumsum(lengths)
    starts = ends - lengths
    high = np.arange(1, len(values) + 1)
    sums = running[high] - running[np.maximum(high - width, np.repeat(starts, lengths))]
    out = np.zeros(len(lengths), dtype=np.int64)
    some = lengths > 0
    if some.any():
        out[some] = np.maximum.reduceat(sums, starts[some])
    return out


def pack_numbers(values: np.ndarray) -> bytes:
    """Numbers >= 0 in groups of seven bits; small ones take one byte."""
    values = values.astype(np.uint64)
    length = np.ones(len(values), dtype=np.int64)
    for k in range(1, 9):
        length += values >= np.uint64(1 << (7 * k))
    start = np.cumsum(length) - length
    out = np.zeros(int(length.sum()), dtype=np.uint8)
    for k in range(int(length.max(initial=0))):
        has = np.flatnonzero(length > k)
        group = (values[has] >> np.uint64(7 * k)).astype(np.uint64) & np.uint64(127)
        out[start[has] + k] = group.astype(np.uint8) | np.where(length[has] > k + 1, 128, 0).astype(np.uint8)
    return out.tobytes()


def unpack_numbers(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8)
    ends = np.flatnonzero(raw < 128)
    starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
    shift = (np.arange(len(raw)) - np.repeat(starts, ends - starts + 1)) * 7
    parts = (raw & 127).astype(np.int64) << shift
    return np.add.reduceat(parts, starts) if len(starts) else parts


def discounts(counts_of_counts: dict[int, int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts 1, 2, 3+ from the numbers of n-grams seen 1 to 4
    times; where too few or repeated counts make them senseless they are held between
    ``LEAST_DISCOUNT`` and a quarter below the count, so every context leaves some mass to the
    lower order and no n-gram has probability 0."""
    n = [counts_of_counts.get(k, 0) for k in range(1, 5)]
    if not n[0]:
        return 0.5, 0.5, 0.5  # no singletons, as in a tiny or closed set
    y = n[0] / (n[0] + 2 * n[1])
    found = [k + 1 - (k + 2) * y * n[k + 1] / n[k] if n[k] else (k + 1) / 2 for k in range(3)]
    return tuple(min(max(d, LEAST_DISCOUNT), k + 1 - 0.25) for k, d in enumerate(found))


def log_probabilities(counts: DataFrame, order: int, alphabet: int = 257) -> DataFrame:
    """``counts`` (shard, gram, c0, c1, t0, t1: how often the gram is in trusted and in toxic texts
    of either fold, possibly never) -> shard, gram, p0, p1: its interpolated log-probabilities in
    both trusted models, r0, r1: its log-likelihood ratio, toxic to trusted, in steps (null where
    a fold has no toxic text).

    p_n(w|u) = max(c(uw) - D, 0) / c(u) + gamma(u) p_(n-1)(w|u'), with continuation counts in
    place of c below the highest order and 1 / alphabet below order 1. Every D is above 0, so
    every probability is too and no logarithm is null."""
    models = ("c0", "c1", "t0", "t1")
    levels = {order: counts}
    for n in range(order - 1, 0, -1):
        levels[n] = materialise(levels[n + 1].groupBy(F.col("gram").bitwiseAND((1 << (8 * n)) - 1).alias("gram")).agg(
            *(F.count_if(F.col(m) > 0).alias(m) for m in models)), "kn-level")
    # counts of counts: sixteen numbers per order
    tallies = reduce(DataFrame.unionByName, (
        level.agg(F.lit(n).alias("n"), *(F.max(m).alias(m) for m in models),
                  *(F.count_if(F.col(m) == k).alias(f"{m}_{k}") for m in models for k in (1, 2, 3, 4)))
        for n, level in levels.items())).collect()
    cut = {(r["n"], m): discounts({k: r[f"{m}_{k}"] for k in (1, 2, 3, 4)}) for r in tallies for m in models}
    seen = {m: any(r[m] for r in tallies) for m in models}

    lower = None
    for n in range(1, order + 1):
        level = levels[n].withColumn("context", F.shiftright("gram", 8))
        for m in models:
            c, (d1, d2, d3) = F.col(m), cut[n, m]
            level = level.withColumn(f"taken_{m}", F.when(c == 0, 0.0).when(c == 1, d1).when(c == 2, d2).otherwise(d3))
        sums = [F.sum(x).alias(f"{x}_all") for m in models for x in (m, f"taken_{m}")]
        p = level.join(level.groupBy("context").agg(*sums), "context")
        if lower is None:
            p = p.withColumns({f"below_{m}": F.lit(1.0 / alphabet) for m in models})
        else:
            p = p.withColumn("short", F.col("gram").bitwiseAND((1 << (8 * (n - 1))) - 1)).join(lower, "short")
        own = {m: F.when(F.col(f"{m}_all") > 0, (F.col(m) - F.col(f"taken_{m}") + F.col(f"taken_{m}_all") * F.col(f"below_{m}"))
                         / F.col(f"{m}_all")).otherwise(F.col(f"below_{m}")) for m in models}
        if n == order:
            log = {m: F.log(own[m]) for m in models}
            ratio = {f: F.greatest(F.lit(-127), F.least(F.lit(127), F.round(RATIO_STEPS * (log[f"t{f}"] - log[f"c{f}"])))) for f in "01"}
            return p.select("shard", "gram", *(log[f"c{f}"].cast("float").alias(f"p{f}") for f in "01"),
                            *((ratio[f] if seen[f"t{f}"] else F.lit(None)).cast("tinyint").alias(f"r{f}") for f in "01"))
        # the ratio is rounded, so the toxic side needs fewer digits; its logarithm cannot underflow
        lower = materialise(p.select(F.col("gram").alias("short"), *(own[m].alias(f"below_{m}") if m[0] == "c" else F.log(own[m]).cast("float").alias(f"log_{m}")
                                                                     for m in models)), "kn-probabilities")
        lower = lower.select("short", *(F.col(f"below_{m}") if m[0] == "c" else F.exp(f"log_{m}").alias(f"below_{m}") for m in models))


def score_documents(docs: DataFrame, labels: DataFrame, order: int = 5, z: float = 2.0, quantile: float = 0.995,
                    margin: float = 0.25, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    chunk_bytes: int = CHUNK_BYTES * 3 // 4, with_text: bool = False) -> DataFrame:
    """Per document: ``row`` (its other columns), n_bytes, perplexity (per byte), score, threshold,
    toxicity, toxic_limit, kept; with ``with_text`` also its text."""
    if not 2 <= order <= 7:
        raise ValueError("order must be between 2 and 7 (n-grams are kept in longs)")
    chunks, source_bytes = chunk_table(docs, text_col, chunk_bytes)
    shards = max(1, source_bytes // (20 * SHARD_GRAMS) + 1)
    verdict = (pick(labels, doc_id="doc_id", quality="quality", toxic="toxic").where("doc_id is not null").groupBy("doc_id")
               .agg(F.max("quality").alias("best"), F.min("quality").alias("worst"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
               .selectExpr("doc_id", "coalesce(best = 1 and worst = 1 and toxic = 0, false) as trusted", "toxic = 1 as toxic")
               .where("trusted or toxic"))
    ids = chunks.select("chunk", "nth", F.col(f"row.`{id_col}`").alias("doc_id"))
    labelled = materialise(ids.join(verdict, "doc_id").select("chunk", "nth", "trusted", "toxic"), "labelled")

    def fragments(key, left, right):
        w = ChunkGrams(left["text"].to_pylist(), order)
        counts, toxic = (np.bincount(w.which[_marked(left["nth"], right, c)[w.doc]], minlength=len(w.distinct)) for c in ("trusted", "toxic"))
        grams = w.distinct & gram_mask
        rows = [(key[0].as_py(), fold, shard, pack_numbers(np.diff(grams[places], prepend=0)), pack_numbers(counts[places]), pack_numbers(toxic[places]))
                for (fold, shard), places in _by_shard(w.distinct, order, shards)]
        del w, counts, toxic, grams
        give_back()
        columns = zip(*rows, strict=True) if rows else [()] * 6
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["chunk", "fold", "shard", "grams", "counts", "toxic"])

    gram_mask = (1 << (8 * order)) - 1
    sent = chunks.select("chunk", "nth", "text").groupBy("chunk").cogroup(labelled.groupBy("chunk")).applyInArrow(
        fragments, "chunk long, fold long, shard long, grams binary, counts binary, toxic binary")
    # merged once and answered once: dealt by shard and written, so both read it without a shuffle
    buckets = bucket_count(docs.sparkSession, shards)
    sent = bucketed(sent.repartition(buckets, "shard"), "grams", "shard", buckets)

    def merge(key, table):
        grams = [np.cumsum(unpack_numbers(x)) for x in table["grams"].to_pylist()]
        second = np.repeat(table["fold"].to_numpy(), [len(g) for g in grams]) == 1
        codes, distinct = pd.factorize(np.concatenate(grams))
        out = {"shard": pa.array(np.full(len(distinct), key[0].as_py()), pa.int64()), "gram": pa.array(distinct, pa.int64())}
        for name, column in (("c", "counts"), ("t", "toxic")):
            counts = np.concatenate([unpack_numbers(x) for x in table[column].to_pylist()])
            for fold, side in enumerate((~second, second)):
                out[f"{name}{fold}"] = pa.array(np.bincount(codes, weights=counts * side, minlength=len(distinct)).astype(np.int64))
        return pa.table(out)

    counts = materialise(sent.select("fold", "shard", "grams", "counts", "toxic").groupBy("shard").applyInArrow(
        merge, "shard long, gram long, c0 long, c1 long, t0 long, t1 long"), "gram-counts")
    logp = log_probabilities(counts, order)

    def answer(key, left, right):
        place = np.argsort(right["gram"].to_numpy())
        known = right["gram"].to_numpy()[place]
        # a fold is scored by the other's models
        values = [right[p].to_numpy()[place].astype(np.float32) for p in ("p1", "p0")]
        ratios = [None if right[r].null_count else right[r].to_numpy()[place].astype(np.int8) for r in ("r1", "r0")]
        logp, ratio = [], []
        for f, x in zip(left["fold"].to_pylist(), left["grams"].to_pylist(), strict=True):
            at = np.searchsorted(known, np.cumsum(unpack_numbers(x)))
            logp.append(values[f][at].tobytes())
            ratio.append(None if ratios[f] is None else ratios[f][at].tobytes())
        return pa.table([left["chunk"], left["fold"], left["shard"], pa.array(logp, pa.binary()), pa.array(ratio, pa.binary())],
                        names=["chunk", "fold", "shard", "logp", "ratio"])

    answers = sent.select("chunk", "fold", "shard", "grams").groupBy("shard").cogroup(logp.groupBy("shard")).applyInArrow(
        answer, "chunk long, fold long, shard long, logp binary, ratio binary")
    # the trusted documents of a chunk come along as rows of a shard of their own
    none = F.lit(None).cast("binary")
    known = labelled.where("trusted").select("chunk", F.lit(None).cast("long").alias("fold"), F.lit(-1).cast("long").alias("shard"),
                                             none.alias("logp"), none.alias("ratio"), "nth")
    answers = answers.withColumn("nth", F.lit(None).cast("long")).unionByName(known)

    def score(key, left, right):
        order_ = left["nth"].to_numpy()
        w = ChunkGrams(left["text"].to_pylist(), order)
        got = {(f, s): x for f, s, *x in zip(*(right[c].to_pylist() for c in ("fold", "shard", "logp", "ratio")), strict=True)}
        values, ratios = np.zeros(len(w.distinct)), np.zeros(len(w.distinct), dtype=np.int8)
        unknown = set()  # folds without toxic texts to be scored by
        for dealt, places in _by_shard(w.distinct, order, shards):
            logp, ratio = got[dealt]
            values[places] = np.frombuffer(logp, np.float32)
            if ratio is None:
                unknown.add(dealt[0])
            else:
                ratios[places] = np.frombuffer(ratio, np.int8)
        toxicity = strongest_window(ratios[w.which], w.lengths, WINDOW) / RATIO_STEPS
        each = -values[w.which]
        n = w.lengths
        total = np.bincount(w.doc, weights=each, minlength=len(n))
        square = np.bincount(w.doc, weights=each * each, minlength=len(n))
        with np.errstate(invalid="ignore", divide="ignore"):
            mean = total / n
            error = np.sqrt(np.maximum(square / n - mean * mean, 0) / n)
        del each, ratios, values, got
        give_back()
        empty = n == 0
        is_trusted = np.isin(order_, right.filter(pc.equal(right["shard"], -1))["nth"].to_numpy())
        unscored = empty | np.isin(w.fold, list(unknown))
        return pa.table([left["chunk"], left["nth"], left["row"], left["lang"], pa.array(n),
                         pa.array(np.exp(np.where(empty, 0, mean)), mask=empty),
                         pa.array(np.where(empty, 0, mean - z * error), mask=empty), pa.array(toxicity, mask=unscored),
                         pa.array(is_trusted)],
                        names=["chunk", "nth", "row", "lang", "n_bytes", "perplexity", "score", "toxicity", "trusted"])

    scored_schema = StructType([chunks.schema["chunk"], chunks.schema["nth"], chunks.schema["row"],
                                StructField("lang", StringType()), StructField("n_bytes", LongType()),
                                StructField("perplexity", DoubleType()), StructField("score", DoubleType()),
                                StructField("toxicity", DoubleType()), StructField("trusted", BooleanType())])
    lang = F.col(f"row.`{lang_col}`").cast("string").alias("lang")
    scored = materialise(chunks.select("chunk", "nth", "text", "row", lang).groupBy("chunk").cogroup(answers.groupBy("chunk"))
                         .applyInArrow(score, scored_schema), "scored")

    def cut(column):
        mid, high = F.percentile_approx(column, 0.5, 10_000), F.percentile_approx(column, quantile, 10_000)
        return high + F.lit(margin) * (high - mid)

    def toxic_cut():
        mid, high = F.percentile_approx("toxicity", 0.5, 10_000), F.percentile_approx("toxicity", quantile, 10_000)
        few = F.greatest(F.lit(1.0), F.try_divide(F.lit(1 / (1 - quantile)), F.count("toxicity")))
        return high + F.lit(margin) * few * (high - mid)

    good = scored.where("trusted and score is not null")
    overall = good.agg(cut("score"), toxic_cut()).first()
    per_lang = good.where("lang is not null").groupBy("lang").agg(cut("score").alias("own"), toxic_cut().alias("own_toxic"))
    # one language can hold nearly all rows: documents meet one of several copies of its threshold
    copies = per_lang.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    out = scored.withColumn("salt", F.pmod(F.xxhash64("chunk", "nth"), F.lit(SALTS)).cast("int")).join(copies, ["lang", "salt"], "left")
    threshold, toxic_limit = (F.coalesce(c, F.lit(x).cast("double")) for c, x in zip(("own", "own_toxic"), overall, strict=True))
    out = out.select("chunk", "nth", "row", "n_bytes", "perplexity", "score", threshold.alias("threshold"),
                     "toxicity", toxic_limit.alias("toxic_limit"),
                     (F.coalesce(F.col("score") <= threshold, F.lit(True))
                      & F.coalesce(F.col("toxicity") <= toxic_limit, F.lit(True))).alias("kept"))
    if not with_text:
        return out.drop("chunk", "nth")

    def with_texts(key, left, right):
        place = np.argsort(right["nth"].to_numpy(), kind="stable")
        left = left.take(pa.array(np.argsort(left["nth"].to_numpy(), kind="stable")))
        right = right.take(pa.array(place))
        return pa.table([right["row"], left["text"].cast(pa.string()), *(right[c] for c in fields)], names=["row", "text", *fields])

    fields = ["n_bytes", "perplexity", "score", "threshold", "toxicity", "toxic_limit", "kept"]
    schema = StructType([chunks.schema["row"], StructField("text", StringType()), *(out.schema[c] for c in fields)])
    return chunks.select("chunk", "nth", "text").groupBy("chunk").cogroup(out.groupBy("chunk")).applyInArrow(with_texts, schema)


__all__ = ["ChunkGrams", "discounts", "log_probabilities", "score_documents"]
